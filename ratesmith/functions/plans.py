"""Networks that plan names name, beyond their product words; and codes in free text, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratesmith.rules import tables as T

from . import text as X


def _phrases(c: Column, hospital: bool) -> Column:
    """Small letters with one space between words and at both ends; a hospital's plan without what stands behind ' - '."""
    c = F.coalesce(c, F.lit(""))
    c = F.split_part(c, F.lit(" - "), F.lit(1)) if hospital else c
    words = F.regexp_replace(F.lower(F.regexp_replace(c, r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", " ")), r"[^a-z]+", " ")
    return F.concat(F.lit(" "), F.trim(words), F.lit(" "))


def exact_networks(c: Column, hospital: bool) -> Column:
    """Networks that a name names by phrase, sorted. A longer phrase uses its words up, so that a shorter one inside isn't found."""
    def step(state: Column, phrase: Column) -> Column:
        wanted = F.concat(F.lit(" "), phrase["phrase"], F.lit(" "))
        here = F.contains(state["left"], wanted)
        return F.struct(F.when(here, F.replace(state["left"], wanted, F.lit(" "))).otherwise(state["left"]).alias("left"), F.when(here, F.array_append(state["found"], phrase["network"])).otherwise(state["found"]).alias("found"))

    table = F.array(*(F.struct(F.lit(p).alias("phrase"), F.lit(n).alias("network")) for p, n in T.NETWORK_PHRASES))
    start = F.struct(_phrases(c, hospital).alias("left"), F.array().cast("array<string>").alias("found"))
    return F.array_sort(F.array_distinct(F.aggregate(table, start, step)["found"]))


def families(c: Column, hospital: bool) -> Column:
    """Product lines of a name: words of a plan, the beginning of a payer's contract."""
    if hospital:
        return F.array_sort(F.array_intersect(F.split(F.trim(_phrases(c, True)), " "), F.array(*map(F.lit, T.FAMILY_WORDS))))
    squashed = F.replace(_phrases(c, False), F.lit(" "), F.lit(""))
    return F.filter(F.array(*(F.when(squashed.startswith(k), F.lit(v)) for k, v in T.FAMILY_PREFIXES.items())), lambda x: x.isNotNull())


def is_government(c: Column) -> Column:
    return _phrases(c, True).rlike(T.GOVERNMENT)


def fuzzy_verdict(plan: Column, network: Column) -> Column:
    """(verdict, confidence, tier): the rules' verdict, where it is unknown raised by networks that both name. A product line in
    common is reported and no match; products that no commercial network has are never matched."""
    rules = X.plan_verdict(plan, network)
    result = lambda verdict, confidence, tier: F.struct(verdict.alias("verdict") if isinstance(verdict, Column) else F.lit(verdict).alias("verdict"), F.lit(float(confidence)).alias("confidence"), F.lit(tier).alias("tier"))
    blank = (F.coalesce(plan, F.lit("")) == "") | (F.coalesce(network, F.lit("")) == "")
    mine, theirs = exact_networks(plan, True), exact_networks(network, False)
    return (
        F.when(rules == "match", result("match", 1, "rules")).when(rules != "unknown", result(rules, 0, "rules"))
        .when(blank | is_government(plan), result("unknown", 0, "none"))
        .when(F.arrays_overlap(mine, theirs) & (F.size(mine) > 1), result("aggregate", T.EXACT_CONFIDENCE, "exact"))
        .when(F.arrays_overlap(mine, theirs), result("match", T.EXACT_CONFIDENCE, "exact"))
        .when(F.arrays_overlap(families(plan, True), families(network, False)), result("unknown", T.FAMILY_CONFIDENCE, "family"))
        .otherwise(result("unknown", 0, "none"))
    )


def code_candidates(c: Column) -> Column:
    """All (type, code) that a pasted token can mean, leading zeros put back: an array, in the order of preference."""
    token = F.upper(F.replace(F.trim(c), F.lit(" "), F.lit("")))
    pair = r"^\s*(\d{1,3})\s*[-.\s]\s*([1-4])\s*$"
    one = lambda kind, code: F.struct(F.lit(kind).alias("code_type"), code.alias("code"))
    pad = lambda n: F.lpad(token, n, "0")
    severities = [one("APR-DRG", F.concat(pad(3), F.lit(s))) for s in "1234"]
    none = F.array().cast("array<struct<code_type:string,code:string>>")
    return (
        F.when(c.rlike(pair), F.array(one("APR-DRG", F.concat(F.lpad(F.regexp_extract(c, pair, 1), 3, "0"), F.regexp_extract(c, pair, 2)))))
        .when(token.rlike(r"^[A-Z]\d{4}$"), F.array(one("HCPCS", token)))
        .when(token.rlike(r"^(\d{4}[A-Z]|\d{5})$"), F.array(one("CPT", token), one("HCPCS", token)))
        .when(token.rlike(r"^\d{4}$"), F.array(one("APR-DRG", token), one("RC", token), one("CPT", pad(5))))
        .when(token.rlike(r"^\d{1,3}$"), F.array(one("MS-DRG", pad(3)), *severities, one("RC", pad(4)), one("CPT", pad(5))))
        .otherwise(none)
    )


def looks_like_revenue(c: Column) -> Column:
    return F.trim(c).rlike(r"^(0\d{3}|\d{3})$")


def parse_codes(c: Column) -> Column:
    """(codes, bad): all codes of a text, ranges like 360-365 or G0101-G0105 in full, each at its own width; bad are the ranges whose
    ends don't fit each other."""
    found = F.regexp_extract_all(F.upper(F.coalesce(c, F.lit(""))), F.lit(r"\b([A-Z]?\d{3,5}(?:\s*[-\u2013\u2014]\s*[A-Z]?\d{3,5})?)\b"), F.lit(1))
    ends = F.transform(found, lambda x: F.transform(F.split(x, r"\s*[-\u2013\u2014]\s*"), lambda y: F.trim(y)))
    head = lambda x: F.regexp_extract(x, r"^([A-Z]?)", 1)
    digits = lambda x: F.regexp_extract(x, r"(\d+)$", 1)

    def fits(e: Column) -> Column:
        low, high = e[0], e[1]
        return (head(low) == head(high)) & (digits(low) != "") & (F.length(low) == F.length(high)) & (digits(low) <= digits(high))

    def expanded(e: Column) -> Column:
        low, high = digits(e[0]), digits(e[1])
        span = F.transform(F.sequence(low.cast("int"), high.cast("int")), lambda n: F.concat(head(e[0]), F.lpad(n.cast("string"), 5, "0").substr(F.lit(6) - F.length(low), F.length(low))))
        return F.when(F.size(e) == 1, e).when(fits(e), span).otherwise(F.array().cast("array<string>"))

    bad = F.filter(ends, lambda e: (F.size(e) > 1) & ~fits(e))
    return F.struct(F.flatten(F.transform(ends, expanded)).alias("codes"), F.transform(bad, lambda e: F.array_join(e, "-")).alias("bad"))


def _before(c: Column, markers: list[str]) -> tuple[Column, Column]:
    """What stands before the first marker that the text has, and behind it."""
    low = F.lower(c)
    at = reduce(lambda rest, m: F.when(F.contains(low, F.lit(m)), F.struct(F.locate(m, low).alias("at"), F.lit(len(m)).alias("n"))).otherwise(rest), reversed(markers), F.struct(F.lit(0).alias("at"), F.lit(0).alias("n")))
    return F.when(at["at"] > 0, F.substring(c, F.lit(1), at["at"] - 1)).otherwise(c), F.when(at["at"] > 0, F.substring(c, at["at"] + at["n"], F.length(c))).otherwise("")


def parse_rule(c: Column) -> Column:
    """(revenue, procedure, excluded, bad) of a rate sheet's cell: codes before any marker are revenue codes, four digits wide."""
    text, excluded = _before(F.regexp_replace(F.trim(c), r"\s+", " "), T.EXCLUDE_MARKERS)
    text, procedure = _before(text, T.PROCEDURE_MARKERS)
    parts = [parse_codes(x) for x in (text, procedure, excluded)]
    return F.struct(F.array_distinct(F.transform(parts[0]["codes"], lambda x: X.padded_revenue(x))).alias("revenue"), F.array_distinct(parts[1]["codes"]).alias("procedure"), F.array_distinct(parts[2]["codes"]).alias("excluded"), F.concat(*(p["bad"] for p in parts)).alias("bad"))


def with_rules(df: DataFrame, cell: str, name: str) -> DataFrame:
    """df with parse_rule of a cell. A sheet repeats its cells: each distinct one is parsed once, in as many tasks as there are shuffle
    partitions, however few files the rows come from."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = df.select(F.col(cell).alias("_cell")).where("_cell IS NOT NULL").distinct().repartition(parts, "_cell")
    rules = cells.select("_cell", parse_rule(F.col("_cell")).alias(name))
    blank = F.lit(None).cast("string")
    return df.join(rules, F.col(cell) == F.col("_cell"), "left").drop("_cell").withColumn(name, F.coalesce(name, parse_rule(blank)))


def parse_paste(texts: DataFrame, column: str) -> DataFrame:
    """Codes of pasted lines: place, code, rc (of a revenue code pasted before it), raw; the first of equal ones.

    A line's columns stand between tabs, else commas, else spaces; `139 4` is one code with its severity. Of two tabbed columns the
    first is a revenue code if it looks like one, else it is the code. Headers and tokens without a digit go."""
    lines = texts.select(F.posexplode(F.split(column, r"\r\n|\n|\r")).alias("line", "raw")).withColumn("raw", F.trim("raw"))
    raw = F.col("raw")
    tabbed = raw.contains("\t")
    parts = F.when(tabbed, F.split(raw, "\t")).when(raw.contains(","), F.split(raw, ",")).when(raw.rlike(r"^\d{1,3}\s+[1-4]$"), F.array(F.regexp_replace(raw, r"\s+", "-"))).otherwise(F.split(raw, r"\s+"))
    kept = F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: (x != "") & ~x.rlike(T.HEADER_WORDS) & x.rlike(r"\d"))
    one = lambda code, rc: F.struct(F.upper(code).alias("code"), rc.alias("rc"))
    none = F.lit(None).cast("string")
    paired = tabbed & (F.size("kept") >= 2) & looks_like_revenue(F.try_element_at("kept", F.lit(1)))
    first, second = F.try_element_at("kept", F.lit(1)), F.try_element_at("kept", F.lit(2))
    entries = F.when(paired, F.array(one(second, F.lpad(first, 4, "0")))).when(tabbed, F.array(one(first, none))).otherwise(F.transform("kept", lambda x: one(x, none)))
    rows = lines.withColumn("kept", kept).where(F.size("kept") > 0).select("line", "raw", F.posexplode(entries).alias("at", "e"))
    best = rows.groupBy("e").agg(F.min(F.struct("line", "at", "raw")).alias("m"))
    return best.select(F.struct("m.line", "m.at").alias("place"), "e.code", "e.rc", "m.raw")
