"""What would have to change for refused candidates to be compared: levers, weighted by how feasible they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratesmith.rules import tables as T

from .aggregate import first_rows


def _pair(x: tuple[str, str]) -> Column:
    return F.struct(F.lit(x[0]).alias("lever"), F.lit(x[1]).alias("feasibility"))


def lever_for(reason: Column, carrier: Column, in_corpus: Column, known: list[str] = tuple(T.PAYER_ALIASES)) -> Column:
    """(lever, feasibility) of a refusal. A rate without counterpart is told apart by its carrier: not attributed, with rates on the
    payer side, known but without, or not resolved."""
    n = T.NO_COUNTERPART_LEVERS
    none = F.when(F.coalesce(carrier, F.lit("")) == "", _pair(n["unattributed"])).when(in_corpus, _pair(n["in_corpus"])).when(carrier.isin(list(known)), _pair(n["outside_corpus"])).otherwise(_pair(n["unresolved"]))
    return F.coalesce(F.when(reason == T.NO_COUNTERPART, none), *(F.when(reason == r, _pair(x)) for r, x in T.LEVERS.items()), _pair(T.UNKNOWN_LEVER))


def _weight(feasibility: Column) -> Column:
    return F.coalesce(*(F.when(feasibility == k, F.lit(v)) for k, v in T.FEASIBILITY.items()), F.lit(0.0))


def with_levers(refusals: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Refusals with their lever: a carrier is in the corpus if it formed a pair anywhere."""
    corpus = outcomes.where("carrier IS NOT NULL").select(F.col("carrier").alias("_corpus")).distinct()
    rows = refusals.join(corpus, F.col("carrier") == F.col("_corpus"), "left")
    rows = rows.withColumn("_l", lever_for(F.col("reason"), F.col("carrier"), F.col("_corpus").isNotNull()))
    return rows.select(*refusals.columns, "_l.lever", "_l.feasibility", _weight(F.col("_l.feasibility")).alias("weight"))


def by_reason(levers: DataFrame, coverage: DataFrame) -> DataFrame:
    """Reasons and levers over all systems: candidates, their share of all candidates, and that share times its weight."""
    total = coverage.agg(F.sum("candidates").alias("_all"))
    rows = levers.groupBy("reason", "lever", "feasibility").agg(F.sum("candidates").alias("candidates"), F.first("weight").alias("weight"))
    lift = F.when(F.col("_all") > 0, F.col("candidates") / F.col("_all")).otherwise(0.0)
    return rows.join(total).withColumn("lift", lift).withColumn("weighted_lift", F.col("lift") * F.col("weight")).drop("_all", "weight")


def by_lever(reasons: DataFrame) -> DataFrame:
    """Levers by what they would lift; those that are always named stand at zero where nothing is refused for them."""
    rows = reasons.groupBy("lever").agg(F.sum("lift").alias("lift"), F.sum("weighted_lift").alias("weighted_lift"), F.array_join(F.array_sort(F.collect_set("reason")), ", ").alias("reasons"))
    named = reasons.sparkSession.createDataFrame([(x,) for x in T.NAMED_LEVERS], "lever string").join(rows, "lever", "left_anti")
    return rows.unionByName(named.select("lever", F.lit(0.0).alias("lift"), F.lit(0.0).alias("weighted_lift"), F.lit("").alias("reasons")))


def per_system(levers: DataFrame, coverage: DataFrame) -> DataFrame:
    """Each system's share of compared candidates now, with levers as likely as they are feasible, and with billing class in the key."""
    other = F.when(F.col("reason") == "different_billing_class", F.col("candidates")).otherwise(0)
    won = levers.groupBy("system").agg(F.sum(F.col("candidates") * F.col("weight")).alias("_won"), F.sum(other).alias("_other"))
    rows = coverage.select("system", "candidates", "pairs_formed").join(won, "system", "left").fillna(0, ["_won", "_other"])
    n, share = F.col("candidates"), lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return rows.select(
        "system", "candidates", share(F.col("pairs_formed"), n).alias("share_now"), share(F.col("pairs_formed") + F.col("_won"), n).alias("expected"),
        share(F.col("_other"), n).alias("billing_class_share"), share(F.col("pairs_formed"), n - F.col("_other")).alias("billing_class_keyed"),
    )


def by_system_and_carrier(refusals: DataFrame, reason: str, n: int = 8) -> DataFrame:
    """The n largest cells of one reason; ties by system and carrier."""
    carrier = F.when(F.coalesce("carrier", F.lit("")) == "", "(not attributed)").otherwise(F.col("carrier")).alias("carrier")
    cells = refusals.where(F.col("reason") == reason).groupBy("system", carrier).agg(F.sum("candidates").alias("candidates"))
    cells = cells.withColumn("share_of_reason", F.col("candidates") / F.sum("candidates").over(Window.partitionBy()))  # a row for each system and carrier
    return cells.orderBy(F.desc("candidates"), "system", "carrier").limit(n)


def arithmetic_holds(coverage: DataFrame, refusals: DataFrame) -> DataFrame:
    """Of each system: candidates, pairs and refusals, and whether they agree."""
    refused = refusals.groupBy("system").agg(F.sum("candidates").alias("refused"))
    rows = coverage.select("system", "candidates", "pairs_formed").join(refused, "system", "left").fillna(0, ["refused"])
    return rows.withColumn("holds", F.col("candidates") == F.col("pairs_formed") + F.col("refused"))


def plan_unresolved_share(outcomes: DataFrame) -> DataFrame:
    plan = F.sum(F.when(F.col("explanation") == "plan_unresolved", F.col("pairs")).otherwise(0))
    return outcomes.agg(F.when(F.sum("pairs") > 0, plan / F.sum("pairs")).otherwise(0.0).alias("share"))


def judged(changes: DataFrame) -> DataFrame:
    """Changes between two manifests (stem, status, fields: names of what moved) with kind and materiality, the first rule that holds."""
    moved = lambda f: F.array_contains("fields", f)
    rewritten = (F.size("fields") > 0) & (F.size(F.array_except("fields", F.array(*map(F.lit, T.REWRITE_FIELDS)))) == 0)
    answer = lambda kind, m: F.struct(F.lit(kind).alias("kind"), F.lit(m).alias("materiality"))
    rule = F.when(F.col("status") == "unexpected", answer("file_added", "material")).when(F.col("status") == "missing", answer("file_removed", "material"))
    for field, kind, m in T.CHANGES:
        rule = rule.when(moved(field), answer(kind, m))
    rule = rule.when(rewritten, answer("rewritten", "cosmetic")).otherwise(answer("unrecognised", "unknown"))
    return changes.where("status <> 'same'").withColumn("_r", rule).select(*changes.columns, "_r.kind", "_r.materiality")


def changed_fields(before: DataFrame, after: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, status, fields) of two snapshots of files: which of the fields moved, null being a value."""
    a, b = before.select(F.col(key).alias("_a"), *(F.col(f).alias(f"a_{f}") for f in fields)), after.select(F.col(key).alias("_b"), *(F.col(f).alias(f"b_{f}") for f in fields))
    both = a.join(b, F.col("_a") == F.col("_b"), "full")
    moved = F.filter(F.array(*(F.when(~F.col(f"a_{f}").eqNullSafe(F.col(f"b_{f}")), F.lit(f)) for f in fields)), lambda x: x.isNotNull())
    status = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "unexpected").when(F.size(moved) > 0, "changed").otherwise("same")
    one_side = F.col("_a").isNull() | F.col("_b").isNull()
    return both.select(F.coalesce("_a", "_b").alias(key), status.alias("status"), F.when(one_side, F.array().cast("array<string>")).otherwise(moved).alias("fields"))


def watch_summary(assessments: DataFrame) -> DataFrame:
    return assessments.groupBy("kind", "materiality").agg(F.count("*").alias("changes"))


def diagnosed(files: DataFrame) -> DataFrame:
    """Why a file has few rates: kept, rejected, rates, truncated, layout and structure_found decide, the first that holds."""
    c = F.col
    verdict = (
        F.when(c("rows_kept") > 0, "conforms").when(c("truncated"), "truncated").when(~F.coalesce(c("layout").isin(T.KNOWN_LAYOUTS), F.lit(False)) | ~c("structure_found"), "structure_not_found")
        .when(c("rates_yielded") == 0, "no_negotiated_rates").when(c("rows_rejected") > 0, "all_rows_rejected").otherwise("unknown")
    )
    return files.withColumn("verdict", verdict).withColumn("actionable", ~F.col("verdict").isin("conforms", "no_negotiated_rates"))


def validated(proposals: DataFrame, findings: DataFrame, key: str, evidence: list[str]) -> DataFrame:
    """Proposals (key, cause, confidence, evidence) with refused, the first thing that a finding's own columns speak against; null if
    a proposal stands. findings: key, vintage_gap_days, ratio, hospital_plan, payer_plan."""
    c = F.col
    rows = proposals.join(findings.withColumn("_known", F.lit(True)), key, "left")
    unknown = F.size(F.array_except("evidence", F.array(*map(F.lit, evidence)))) > 0
    is_ = lambda x: c("cause") == x
    refused = (
        F.when(c("_known").isNull(), "no such finding").when(~c("cause").isin(T.CAUSES), "unknown cause").when(~c("confidence").between(0, 1), "confidence out of range")
        .when(unknown, "cites unknown fields").when((F.size("evidence") == 0) & ~is_("insufficient_evidence"), "no evidence")
        .when(is_("vintage_artifact") & c("vintage_gap_days").isNull(), "vintage gap unknown").when(is_("vintage_artifact") & (c("vintage_gap_days") < T.MIN_ARTIFACT_DAYS), "vintage gap too small")
        .when(is_("units_or_methodology") & (F.coalesce(c("ratio"), F.lit(0.0)) == 0), "ratio unknown")
        .when(is_("units_or_methodology") & (F.greatest(c("ratio"), F.try_divide(F.lit(1.0), "ratio")) < T.MIN_UNITS_RATIO), "ratio too small")
        .when(is_("plan_mismatch") & (F.trim(F.coalesce("hospital_plan", F.lit(""))) == "") & (F.trim(F.coalesce("payer_plan", F.lit(""))) == ""), "no plan named")
    )
    return rows.withColumn("refused", refused).drop("_known")


def stratified(rows: DataFrame, strata: list[str], always: Column, size: int, key: list[str], seed: int = 20260926) -> DataFrame:
    """All rows under `always`, and of the rest as many as there are places left, shared over strata in proportion to their sizes, the
    largest remainders first; within a stratum those least by a hash of the key."""
    sure, rest = rows.where(always), rows.where(~always)
    whole = rest.agg(F.count("*").alias("_rest")).join(sure.agg(F.count("*").alias("_sure")))
    counts = rest.groupBy(*strata).agg(F.count("*").alias("_n")).join(whole)
    places = F.least(F.greatest(F.lit(size) - F.col("_sure"), F.lit(0)), F.col("_rest"))
    counts = counts.withColumns({"_places": places, "_get": F.floor(places * F.col("_n") / F.col("_rest"))})
    all_ = Window.partitionBy()  # a row for each stratum
    order = Window.orderBy(F.desc(F.pmod(F.col("_places") * F.col("_n"), F.col("_rest"))), *strata)
    counts = counts.withColumns({"_left": F.col("_places") - F.sum("_get").over(all_), "_i": F.row_number().over(order)})
    counts = counts.select(*(F.col(c).alias(f"_s_{c}") for c in strata), (F.col("_get") + F.when(F.col("_i") <= F.col("_left"), 1).otherwise(0)).alias("_take"))
    on = [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in strata]
    picked = first_rows(rest.withColumn("_draw", F.xxhash64(F.lit(seed), *key)), strata, [F.col("_draw"), *map(F.col, key)], size, "_rank").join(counts, on).where("_rank <= _take")
    return sure.unionByName(picked.select(*rows.columns))
