"""Where and whose a facility is: regions, peer groups, facilities of plan suffixes and file names, crosswalk decisions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratesmith.functions import text as X
from ratesmith.rules import tables as T

from .aggregate import first_rows
from .resolve import OFTEN, likeness, word_candidates

PREFIX = 12


def name_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "")


def _lookup(c: Column, table: dict[str, list[str]]) -> Column:
    return F.coalesce(*(F.when(c.isin(names), F.lit(region)) for region, names in table.items()))


def counties(names: DataFrame, known: DataFrame, facility: str = "facility") -> DataFrame:
    """Adds county: that of the known facility with the same name; else, for names of twelve letters and digits or more, of the
    first known one (by ord) that begins alike, in twelve places or all that the shorter one has.

    known: name, county, ord. Beginnings are joined by equality: a name asks with each of its own, a known one has only one.
    """
    table = known.select(name_key(F.col("name")).alias("_name"), "county", "ord").where("_name <> ''")
    exact = first_rows(table, ["_name"], [F.desc("ord")]).select(F.col("_name").alias("_key"), F.col("county").alias("_exact"))  # a later row with one name replaces an earlier one
    keys = names.select(facility).distinct().withColumn("_key", name_key(F.col(facility)))
    asks = keys.where(F.length("_key") >= PREFIX).withColumn("_start", F.explode(F.transform(F.sequence(F.lit(1), F.lit(PREFIX)), lambda n: F.substring("_key", F.lit(1), n))))
    starts = table.withColumn("_start", F.substring("_name", 1, PREFIX))
    near = asks.join(starts, "_start").groupBy(facility).agg(F.min_by("county", "ord").alias("_near"))
    found = keys.join(exact, "_key", "left").join(near, facility, "left").select(facility, F.coalesce("_exact", "_near").alias("county"))
    return names.join(found, facility, "left")


def regions(rows: DataFrame, known: DataFrame, facility: str = "facility", system: str = "system") -> DataFrame:
    """Adds region: by a part of the facility's name, else by its county, else by its system."""
    hint = F.coalesce(*(F.when(F.contains(F.lower(F.col(facility)), F.lit(part)), F.lit(region)) for part, region in T.REGION_HINTS))
    by_county = F.when(F.col("county").isNotNull(), F.coalesce(_lookup(F.col("county"), T.COUNTY_REGIONS), F.lit(T.UNKNOWN_REGION)))
    return counties(rows, known, facility).withColumn("region", F.coalesce(hint, by_county, _lookup(F.col(system), T.SYSTEM_REGIONS), F.lit(T.UNKNOWN_REGION)))


def peer_groups(rows: DataFrame, system: str = "system", least: int = 2) -> DataFrame:
    """Regions with enough systems to compare."""
    groups = rows.where(F.col("region") != T.UNKNOWN_REGION).groupBy("region").agg(F.array_sort(F.collect_set(system)).alias("systems"))
    return groups.where(F.size("systems") >= least)


def suffix_of(c: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(F.trim(F.coalesce(c, F.lit(""))), r"-\s*([A-Za-z]{2,6})\s*$", 1)), F.lit(""))


def facility_of_file(c: Column) -> Column:
    """The hospital that a file's name names, as the naming convention has it; else empty."""
    name = F.regexp_extract(F.regexp_replace(F.split_part(F.coalesce(c, F.lit("")), F.lit("?"), F.lit(1)), "/+$", ""), r"([^/]*)$", 1)
    words = F.filter(F.split(F.regexp_extract(name, r"(?i)^(?:\d[\d-]*_)?(.+?)[_-]standardcharges", 1), r"[-_\s]+"), lambda w: w != "")
    shown = F.transform(words, lambda w, i: F.when((i > 0) & F.lower(w).isin(T.MINOR_WORDS), F.lower(w)).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, F.lit(2), F.length(w)))))
    return F.array_join(shown, " ")


def ambiguous_locations(rows: DataFrame, location: str = "location_name", source: str = "source_url") -> DataFrame:
    """Location labels that more than one file has."""
    return rows.where((F.coalesce(location, F.lit("")) != "") & (F.coalesce(source, F.lit("")) != "")).groupBy(location).agg(F.countDistinct(source).alias("sources")).where("sources > 1")


def resolve_facilities(rows: DataFrame, maps: dict[str, dict[str, str]] = T.FACILITY_SUFFIXES) -> DataFrame:
    """Adds facility to rows (hospital, location_name, plan_name, source_url): by the plan's suffix where the system has a map, by the
    file's name where several files share the location, else the location or the hospital."""
    suffix = suffix_of(F.col("plan_name"))
    mapped = [F.when((F.col("hospital") == system) & (suffix == k), F.lit(v)) for system, m in maps.items() for k, v in m.items()]
    shared = ambiguous_locations(rows).select(F.col("location_name").alias("_shared"))
    named = F.when(F.col("_shared").isNotNull(), F.nullif(facility_of_file(F.col("source_url")), F.lit("")))
    label = F.trim(F.coalesce(F.nullif(F.col("location_name"), F.lit("")), F.col("hospital"), F.lit("")))
    return rows.join(shared, F.col("location_name") == F.col("_shared"), "left").withColumn("facility", F.coalesce(*mapped, named, label)).drop("_shared")


def distinct_locations(resolved: DataFrame) -> DataFrame:
    return resolved.where("facility <> ''").select("facility").distinct()


def multi_facility(resolved: DataFrame, source: str = "source_url") -> DataFrame:
    """Of each file, how many facilities its rows resolve to, and whether that is more than one."""
    return resolved.groupBy(source).agg(F.countDistinct("facility").alias("facilities"), (F.countDistinct("facility") > 1).alias("multi"))


def _plain(c: Column, left_out: str) -> Column:
    c = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?<=[a-z])(?=[A-Z])", " "), T.NAME_SEPARATORS, " ")
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"[^\w\s]+", " "), left_out, " "), r"\s+", " ")))


def match_locations(locations: DataFrame, known: DataFrame, by_state: bool = False, often: int = OFTEN) -> DataFrame:
    """Of each distinct location name the known facility it is most like: id, score, second (the runner-up's), method, sure.

    One facility with exactly this name settles it. Else the score is the Jaccard similarity of the words that tell names apart, ties
    to the lesser id; a name whose every word several facilities have is a system's, and its score counts as a tie. locations: name
    (and state), known: id, name (and state): with by_state only facilities of the location's state are looked at, and a name's
    words meet only those of its state. Candidates are facilities that share a word, but words that many have aren't joined on.
    """
    keys = ["name", "state"] if by_state else ["name"]
    a = locations.select(*keys).distinct().withColumns({"_exact": _plain(F.col("name"), T.NAME_ARTICLES), "_words": F.array_distinct(F.filter(F.split(_plain(F.col("name"), T.NAME_NOISE), " "), lambda x: F.length(x) > 1))})
    b = known.select("id", F.col("name").alias("facility"), *(["state"] if by_state else [])).withColumns({"_f_exact": _plain(F.col("facility"), T.NAME_ARTICLES), "_f_words": F.array_distinct(F.filter(F.split(_plain(F.col("facility"), T.NAME_NOISE), " "), lambda x: F.length(x) > 1))})
    on = keys[1:]
    same = a.withColumn("_k", F.col("_exact")).join(b.withColumn("_k", F.col("_f_exact")), [*on, "_k"])
    exact = same.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("id").alias("id"), F.min("facility").alias("facility")).where("_n = 1").drop("_n")
    rounded = lambda both, n, m: F.round(likeness(both, n, m), 4)
    pairs = word_candidates(a.select(*keys, F.col("_words").alias("_aw")), b.select(*on, "id", "facility", F.col("_f_words").alias("_bw")), keys, ["id", "facility"], on, rounded, often)
    pairs = pairs.withColumn("score", rounded(F.col("_both"), F.col("_a"), F.col("_b")))
    order = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "id", "facility")))
    best = pairs.groupBy(*keys).agg(order.alias("_l"), F.max("_supers").alias("_supers"))
    first, next_ = F.element_at("_l", 1), F.coalesce(-F.try_element_at("_l", F.lit(2))["s"], F.lit(0.0))
    best = best.select(*keys, first["id"].alias("_b_id"), first["facility"].alias("_b_facility"), (-first["s"]).alias("_b_score"), F.when(F.col("_supers") > 1, -first["s"]).otherwise(next_).alias("_b_second"), (F.col("_supers") > 1).alias("_vague"))
    rows = a.select(*keys).join(exact, keys, "left").join(best, keys, "left")
    hit = F.col("id").isNotNull()
    out = rows.select(
        *keys, F.coalesce("id", "_b_id").alias("id"), F.coalesce("facility", "_b_facility").alias("facility"), F.when(hit, 1.0).otherwise(F.coalesce("_b_score", F.lit(0.0))).alias("score"),
        F.when(hit, 0.0).otherwise(F.coalesce("_b_second", F.lit(0.0))).alias("second"), F.when(hit, "exact name").when(F.col("_b_id").isNull(), "no token overlap").when(F.col("_vague"), "under-specified").otherwise("token-overlap").alias("method"),
    )
    return out.withColumn("sure", F.col("id").isNotNull() & (F.col("score") >= T.REVIEW_SCORE) & (F.col("score") - F.col("second") >= T.CLEAR_MARGIN))


def resolve_crosswalk(locations: DataFrame, known: DataFrame, decisions: DataFrame) -> DataFrame:
    """Each distinct location once: a confirmed id beats a rejection, that beats the scorer; what isn't sure goes to a reviewer.

    locations: name; known: name, id; decisions: name, id (null: rejected)."""
    decided = decisions.groupBy("name").agg(F.max("id").alias("confirmed"), F.lit(True).alias("_decided"))
    rows = match_locations(locations, known).join(decided, "name", "left")
    routed = F.when(F.col("confirmed").isNotNull(), "accepted").when(F.col("_decided"), "rejected").when(F.col("sure"), "accepted").otherwise("review")
    return rows.select("name", F.coalesce("confirmed", F.when(F.col("_decided").isNull() & F.col("sure"), F.col("id"))).alias("id"), "score", "method", routed.alias("routed_to"))


def crosswalk_report(resolved: DataFrame) -> DataFrame:
    return resolved.groupBy("routed_to").agg(F.count("*").alias("locations"))


def geography(facilities: DataFrame, wages: DataFrame) -> DataFrame:
    """Each facility's area (payment area, else geographic) and wage index: by its own id, else by area, else none.

    facilities: ccn, payment_cbsa, geographic_cbsa; wages: kind (ccn or cbsa), key, wage_index."""
    by = lambda kind: wages.where(F.col("kind") == kind).groupBy(F.col("key").alias(f"_{kind}")).agg(F.min("wage_index").alias(f"_w_{kind}"))
    rows = facilities.withColumn("cbsa", F.coalesce("payment_cbsa", "geographic_cbsa"))
    rows = rows.join(by("ccn"), F.col("ccn") == F.col("_ccn"), "left").join(by("cbsa"), F.col("cbsa") == F.col("_cbsa"), "left")
    return rows.withColumn("wage_index", F.coalesce("_w_ccn", "_w_cbsa")).drop("_ccn", "_cbsa", "_w_ccn", "_w_cbsa")


def system_of(name: Column, systems: list[tuple[str, str]], other: str) -> Column:
    """The first system whose pattern a registered name has; none for names that the pattern `other` has."""
    hit = F.coalesce(*(F.when(name.rlike(f"(?i){pattern}"), F.lit(system)) for system, pattern in systems))
    return F.when((F.coalesce(name, F.lit("")) != "") & ~F.coalesce(name.rlike(f"(?i){other}"), F.lit(False)), hit)


def lookup_last(rows: DataFrame, keys: list[str], ord_: str) -> DataFrame:
    """One row a key: the last one listed."""
    return first_rows(rows, keys, [F.desc(ord_)]).drop("rank")


def lookup_first(rows: DataFrame, keys: list[str], ord_: str) -> DataFrame:
    return first_rows(rows, keys, [F.col(ord_)]).drop("rank")


def corrected(rows: DataFrame, corrections: DataFrame, service: str = "service", text: str = "text") -> DataFrame:
    """Confirmed replacements for named services; a service has at most one."""
    c = corrections.where("confirmed").select(F.col("service").alias("_service"), "find", F.col("replace").alias("_replace"))
    out = F.when(F.col("_service").isNotNull(), F.replace(F.col(text), F.col("find"), F.col("_replace"))).otherwise(F.col(text))
    return rows.join(c, F.col(service) == F.col("_service"), "left").withColumn(text, out).drop("_service", "find", "_replace")


def candidates_from_pairs(pairs: DataFrame, separator: str = " || ") -> DataFrame:
    """payer and plan of counted pairs, most lines first."""
    part = lambda i: X.stripped(F.split_part("pair", F.lit(separator), F.lit(i)))
    return pairs.select(part(1).alias("payer"), part(2).alias("plan"), "lines").orderBy(F.desc("lines"), "payer", "plan")


def all_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests, F.lit(True))
