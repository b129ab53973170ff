"""Scores of matchers and triagers against labels, gates on them; profiles of files; runs of jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratesmith.functions import numbers as N
from ratesmith.functions import text as X
from ratesmith.rules import tables as T


def load_labels(rows: DataFrame, key: list[str], vocabulary: dict[str, list[str]]) -> DataFrame:
    """Labels as they are; a value outside its vocabulary or a key that comes twice stops the read."""
    checked = rows
    for c, words in vocabulary.items():
        ok = F.coalesce(F.col(c).isin(words), F.lit(False))
        checked = checked.withColumn(c, F.when(ok, F.col(c)).otherwise(F.raise_error(F.concat(F.lit(f"{c}: unknown value "), F.coalesce(F.col(c).cast("string"), F.lit("null")))).cast(rows.schema[c].dataType)))
    grouped = checked.groupBy(*key).agg(F.count("*").alias("_n"), *(F.first(c).alias(c) for c in rows.columns if c not in key))
    once = F.when(F.col("_n") == 1, F.col(key[0])).otherwise(F.raise_error(F.concat(F.lit("label comes twice: "), F.concat_ws(", ", *(F.col(k).cast("string") for k in key)))).cast(rows.schema[key[0]].dataType))
    return grouped.withColumn(key[0], once).select(*rows.columns)


def triage_scores(labels: DataFrame, queue: DataFrame, key: list[str], expected: str, got: str) -> DataFrame:
    """One row: labels, scored, unmatched, correct, wrong, abstained (no answer, or insufficient_evidence), precision, coverage."""
    met = labels.join(queue.select(*key, got, F.lit(True).alias("_there")), key, "left")
    answer = F.when(F.col(got) != "insufficient_evidence", F.col(got))
    n = met.agg(
        F.count("*").alias("labels"), F.count("_there").alias("scored"), F.count_if(F.col("_there").isNull()).alias("unmatched"), F.count_if(F.col("_there") & (answer == F.col(expected))).alias("correct"),
        F.count_if(F.col("_there") & (answer != F.col(expected))).alias("wrong"), F.count_if(F.col("_there") & answer.isNull()).alias("abstained"),
    )
    said = (F.col("correct") + F.col("wrong")).cast("double")
    return n.withColumns({"precision": F.when(said > 0, F.col("correct") / said), "coverage": N.ratio(said, F.col("scored").cast("double"))})


def gate(scores: DataFrame, least: float = T.MIN_PRECISION) -> DataFrame:
    """Whether scores let a triager write causes, and why not."""
    why = F.when(F.col("labels") == 0, "no labels").when(F.col("precision").isNull(), "abstained throughout").when(F.col("precision") < least, "precision too low")
    return scores.withColumns({"passed": why.isNull(), "why": F.coalesce(why, F.lit("passed"))})


def beats_baseline(candidate: DataFrame, baseline: DataFrame, gain: float = T.MIN_GAIN) -> DataFrame:
    """Whether one row of scores (precision, f1) is worth it over another: no precision lost, F1 up by the gain."""
    both = candidate.select(F.col("precision").alias("a_precision"), F.col("f1").alias("a_f1")).join(baseline.select(F.col("precision").alias("b_precision"), F.col("f1").alias("b_f1")))
    why = F.when(F.col("a_precision") < F.col("b_precision"), "precision regressed").when(F.col("a_f1") - F.col("b_f1") < gain, "gain too small")
    return both.withColumns({"beats": why.isNull(), "why": F.coalesce(why, F.lit("passed"))})


def compare_scores(scores: DataFrame) -> DataFrame:
    return scores.orderBy(F.desc("f1"), "name")


def reviewed_share(labels: DataFrame, reviewed: str) -> DataFrame:
    return labels.agg(F.count("*").alias("labels"), F.count_if(F.col(reviewed)).alias("reviewed"), N.ratio(F.count_if(F.col(reviewed)).cast("double"), F.count("*").cast("double")).alias("share"))


def profile(rows: DataFrame) -> DataFrame:
    """Composition of price rows, one pass: counter, value, lines; by payer and plan, methodology, value kind, product, product and kind.

    Rows are counted by all of these first; names are classified once for each pair of them that occurs."""
    payer, plan = (F.trim(F.coalesce(c, F.lit(""))) for c in ("payer_name", "plan_name"))
    present = lambda c: X.folded(F.col(c)) != ""
    kind = F.when(present("rate_dollar"), "dollar").when(present("rate_algorithm"), "algorithm").when(present("rate_percentage"), "percentage").otherwise("none")
    methodology = F.coalesce(F.nullif(F.lower(F.trim(F.coalesce("methodology", F.lit("")))), F.lit("")), F.lit("(blank)"))
    each = rows.where((payer != "") | (plan != "")).groupBy(payer.alias("payer"), plan.alias("plan"), methodology.alias("methodology"), kind.alias("kind")).agg(F.count("*").alias("lines"))
    names = each.withColumns({"_payer": X.normalise_name(F.col("payer")), "_plan": X.normalise_name(F.col("plan"))}).withColumn("product", X.product_of(F.col("_payer"), F.col("_plan")))
    one = lambda name, value: F.struct(F.lit(name).alias("counter"), value.alias("value"))
    counted = F.array(one("pairs", F.concat("payer", F.lit(" || "), "plan")), one("methodology", F.col("methodology")), one("value_kind", F.col("kind")), one("product_class", F.col("product")), one("joint", F.concat("product", F.lit("|"), "kind")))
    return names.select(F.explode(counted).alias("c"), "lines").groupBy("c.counter", "c.value").agg(F.sum("lines").alias("lines"))


def spread_by_code(rows: DataFrame) -> DataFrame:
    return rows.groupBy("code").agg(F.median("relative_difference").alias("median_relative_difference"), F.count("*").alias("pairs"))


def queue_summary(queue: DataFrame) -> DataFrame:
    """One row: findings, groups of code and carrier, findings of the largest carrier and their share."""
    each = queue.groupBy("carrier").agg(F.count("*").alias("n"), F.countDistinct("code").alias("groups"))
    return each.agg(F.sum("n").alias("findings"), F.sum("groups").alias("groups"), F.max("n").alias("largest"), N.ratio(F.max("n").cast("double"), F.sum("n").cast("double")).alias("concentration"))


def classed_groups(groups: DataFrame, tight: float = 0.10) -> DataFrame:
    """Service groups with what they look like: one finding, one direction and tight, one direction, or both."""
    one_way = (F.col("up") == 0) | (F.col("down") == 0)
    return groups.withColumn("class", F.when(F.col("findings") < 2, "single").when(one_way & (F.col("spread") <= tight), "consistent_offset").when(one_way, "one_direction").otherwise("mixed"))


def case_mix(volumes: DataFrame, facility: str, payers: list[str]) -> DataFrame:
    """Cases of a facility's named payers by drg and severity, and the payers' share of all its cases."""
    rows = volumes.where(F.col("facility") == facility)
    whole = rows.agg(F.sum("cases").alias("_all"))
    mine = rows.where(F.col("payer").isin(payers)).groupBy("drg", "severity").agg(F.sum("cases").alias("cases"))
    return mine.join(whole).withColumn("share", N.ratio(F.col("cases").cast("double"), F.col("_all").cast("double"))).drop("_all")


def usable_volumes(rows: DataFrame) -> DataFrame:
    """Typed volumes of raw text rows; those without facility, drg or a positive number of cases go."""
    typed = rows.withColumns({"cases": F.regexp_replace("cases", ",", "").try_cast("int"), "severity": F.col("severity").try_cast("int")})
    return typed.where((F.coalesce("facility", F.lit("")) != "") & (F.coalesce("drg", F.lit("")) != "") & (F.col("cases") > 0))


def runs(events: DataFrame, key: list[str], kind: str, at: str) -> DataFrame:
    """Attempts of events: when they started, ended and were last seen, their peak, and how they came out.

    kind is start, end or anything else; events have value (a number, of end events the exit code)."""
    of = lambda k, c: F.when(F.col(kind) == k, F.col(c))
    rows = events.groupBy(*key).agg(F.min(of("start", at)).alias("started"), F.max(of("end", at)).alias("ended"), F.max_by("value", of("end", at)).alias("exit_code"), F.max(at).alias("last_seen"), F.max("value").alias("peak"), F.count("*").alias("events"))
    outcome = F.when(F.col("ended").isNull(), "killed or running").when(F.col("exit_code") == 0, "succeeded").otherwise("failed")
    return rows.where("started IS NOT NULL").withColumn("outcome", outcome)


def worst_slice(events: DataFrame, key: list[str], slice_: str, value: str) -> DataFrame:
    """Attempts with their peak, and the slice in which it was: of ties the first by name."""
    worst = events.groupBy(*key).agg(F.min_by(slice_, F.struct(-F.col(value), F.col(slice_))).alias("worst_slice"), F.max(value).alias("worst_value"))
    return events.groupBy(*key).agg(F.count("*").alias("events")).join(worst, key, "left")


def durations(events: DataFrame, stage: str, seconds: str, failed: Column) -> DataFrame:
    return events.groupBy(stage).agg(F.count("*").alias("runs"), F.median(seconds).alias("median_s"), F.max(seconds).alias("max_s"), F.count_if(failed).alias("failures"))


def merged_provenance(rows: DataFrame, key: list[str]) -> DataFrame:
    """Figures' origins as one: rows summed, newest and oldest date, least coverage, all sources and caveats once."""
    listed = lambda c: F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))), " | ")
    return rows.groupBy(*key).agg(F.sum("rows").alias("rows"), F.sum("excluded").alias("excluded"), F.max("date").alias("newest"), F.min("date").alias("oldest"), F.min("coverage").alias("coverage"), listed("sources").alias("sources"))


def latest_ingest(paths: DataFrame, path: str = "path") -> DataFrame:
    """Under each root: the newest ingest_date that its paths name, the tail under it, and how many files there are."""
    date = F.nullif(F.regexp_extract(path, r"ingest_date=(\d{4}-\d{2}-\d{2})", 1), F.lit(""))
    rows = paths.select(F.regexp_extract(path, r"^([^/]+)/", 1).alias("root"), date.alias("date"), F.regexp_extract(path, r"carrier=([^/]+)", 1).alias("group"))
    return rows.groupBy("root").agg(F.max("date").alias("ingest_date"), F.count("*").alias("files"), F.countDistinct(F.nullif("group", F.lit(""))).alias("groups"))


def footprint(files: DataFrame, size: str, done: int, planned: int, limit: int) -> DataFrame:
    """Files and bytes there are, what all planned systems would take, and how far that is over the limit."""
    n = files.agg(F.count("*").alias("files"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"))
    return n.withColumn("projected", (F.col("bytes") * planned / done).cast("long")).withColumn("over", F.greatest(F.col("projected") - limit, F.lit(0).cast("long")))


def short_hash(*columns: Column, digits: int = 16) -> Column:
    """Some hex digits that stand for values in their order, null as empty."""
    return F.substring(F.sha2(F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns)), 256), 1, digits)
