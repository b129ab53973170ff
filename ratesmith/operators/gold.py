"""The published tables, each a group-by over the outcomes of the distribution join (explained, offsets applied)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratesmith.functions import numbers as N

from .aggregate import first_rows, p90_nearest

#: Any total order of residual rows that is the same on every run.
TIES = ["code", "code_type", "facility", "plan", "setting", "billing_class", "vintage", "rate", "payer_median"]


def residual(rows: DataFrame) -> DataFrame:
    """Material differences that nothing explains."""
    return rows.where("outcome = 'compared' AND is_material AND explanation = 'unexplained'").withColumn("difference", F.col("payer_median") - F.col("rate"))


def outcomes(rows: DataFrame) -> DataFrame:
    return rows.where("outcome = 'compared'").groupBy("system", "facility", "carrier", "code_type", "explanation").agg(F.count("*").alias("pairs"), F.count_if("is_material").alias("material_pairs"))


def refusals(rows: DataFrame) -> DataFrame:
    return rows.where("outcome <> 'compared'").groupBy(F.col("outcome").alias("reason"), "system", "facility", "carrier", "code_type").agg(F.count("*").alias("candidates"))


def _residual_flag() -> Column:
    return (F.col("outcome") == "compared") & F.col("is_material") & (F.col("explanation") == "unexplained")


def coverage(rows: DataFrame) -> DataFrame:
    """The funnel of each system, in one pass."""
    done, other = F.col("outcome") == "compared", F.col("outcome") == "different_billing_class"
    return rows.groupBy("system").agg(
        F.count("*").alias("candidates"), F.count_if(done).alias("pairs_formed"), (F.count_if(done) / F.count("*")).alias("comparable_share"),
        F.count_if(~other).alias("like_class_candidates"), N.ratio(F.count_if(done).cast("double"), F.count_if(~other).cast("double")).alias("like_class_share"),
        F.count_if(done & F.col("is_material")).alias("material"), F.count_if(_residual_flag()).alias("unexplained_and_material"),
        F.countDistinct("facility").alias("facilities"), F.countDistinct(F.when(done, F.col("carrier"))).alias("carriers"),
    )


def magnitude(rows: DataFrame) -> DataFrame:
    """Sizes of the residual per system, carrier and code type."""
    left, keys = residual(rows), ["system", "carrier", "code_type"]
    sizes = left.groupBy(*keys).agg(
        F.count("*").alias("residual_pairs"), F.median("relative_difference").alias("median_relative_difference"),
        F.median(F.abs("difference")).alias("median_abs_difference_usd"), F.count_if("is_implausible").alias("implausible_pairs"),
    )
    return sizes.join(p90_nearest(left, keys, "relative_difference").withColumnRenamed("p90", "p90_relative_difference"), keys)


def exemplars(rows: DataFrame, n: int = 25) -> DataFrame:
    """The widest residual rows of each carrier of each system."""
    return first_rows(residual(rows), ["system", "carrier"], [F.desc("relative_difference"), *TIES], n)


def residual_top(rows: DataFrame, n: int = 100) -> DataFrame:
    """The widest residual rows of each facility and carrier of each system, by dollars."""
    return first_rows(residual(rows), ["system", "facility", "carrier"], [F.desc(F.abs("difference")), *TIES], n)


def pairs(rows: DataFrame) -> DataFrame:
    """One row for each facility and carrier, for rankings."""
    done, other = F.col("outcome") == "compared", F.col("outcome") == "different_billing_class"
    gap = F.when(done & (F.col("ratio") > 0), F.col("ratio") - 1.0)
    out = rows.groupBy("system", "facility", "carrier").agg(
        F.count("*").alias("hospital_rates"), F.count_if(done).alias("compared"), F.count_if(done & F.col("is_material")).alias("material"),
        F.count_if(_residual_flag()).alias("unexplained_material"), F.median(gap).alias("median_signed_gap"),
        F.sum(F.when(_residual_flag(), F.abs(F.col("payer_median") - F.col("rate"))).cast("decimal(28,9)")).cast("double").alias("summed_abs_gap_usd"),
        F.count_if(done & F.col("inside")).alias("_inside"), F.count_if(~other).alias("_like"),
    )
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b))
    return out.withColumns({"summed_abs_gap_usd": F.coalesce("summed_abs_gap_usd", F.lit(0.0)), "inside_range_share": share("_inside", "compared"), "like_class_share": share("compared", "_like")}).drop("_inside", "_like")


def rates(rows: DataFrame, carriers: DataFrame) -> DataFrame:
    """Facility, carrier, code and its type: medians, the payer's spread, and the most frequent account or refusal (ties by name).

    carriers: those the payer side has, by system; others have no insurer rate to look up."""
    wanted = carriers.select("system", F.lower("carrier").alias("_carrier")).distinct()
    rows = rows.join(wanted, (rows["system"] == wanted["system"]) & (F.lower(rows["carrier"]) == wanted["_carrier"]), "left_semi")
    keys, done = ["system", "facility", "carrier", "code", "code_type"], F.col("outcome") == "compared"
    kind = F.when(done, F.col("explanation_before")).otherwise(F.col("outcome"))
    each = rows.withColumns({"_done": done, "_kind": kind}).groupBy(*keys, "_done", "_kind").agg(F.count("*").alias("_n"))
    modes = each.groupBy(*keys).agg(*(F.min_by(F.when(flag, F.col("_kind")), F.when(flag, F.struct(-F.col("_n"), "_kind"))).alias(name) for name, flag in (("explanation_before_offsets", F.col("_done")), ("refusal", ~F.col("_done")))))
    out = rows.groupBy(*keys).agg(
        F.count("*").alias("hospital_rates"), F.median("rate").alias("hospital_rate"), F.count_if(done).alias("compared"), F.min("payer_min").alias("payer_min"),
        F.median("payer_median").alias("payer_median"), F.max("payer_max").alias("payer_max"), F.max("n").alias("payer_count"), F.count_if(done & F.col("inside")).alias("_inside"),
    )
    out = out.withColumn("inside_share", F.when(F.col("compared") > 0, F.col("_inside") / F.col("compared"))).drop("_inside").join(modes, keys)
    return out.withColumns({"explanation_before_offsets": F.coalesce("explanation_before_offsets", F.lit("")), "refusal": F.when(F.col("compared") > 0, "").otherwise(F.coalesce("refusal", F.lit("")))})


def codes(rows: DataFrame, keys: list[str], description: str) -> DataFrame:
    """Each code's description with the most rows, of ties the least."""
    n = rows.groupBy(*keys, description).agg(F.count("*").alias("rows"))
    return first_rows(n, keys, [F.desc("rows"), description]).drop("rank")


def measures(rows: DataFrame) -> DataFrame:
    """Coverage and all reasons and explanations in long form: system, measure, name, value."""
    funnel = ["candidates", "pairs_formed", "material", "unexplained_and_material"]
    wide = coverage(rows).select("system", *(F.col(c).cast("long").alias(c) for c in funnel)).unpivot("system", funnel, "name", "value").withColumn("measure", F.lit("coverage"))
    kind = F.when(F.col("outcome") == "compared", F.struct(F.lit("explanation").alias("measure"), F.col("explanation").alias("name"))).otherwise(F.struct(F.lit("refusal").alias("measure"), F.col("outcome").alias("name")))
    counts = rows.groupBy("system", kind.alias("_k")).agg(F.count("*").alias("value")).select("system", "_k.measure", "_k.name", "value")
    return wide.unionByName(counts).select("system", "measure", "name", "value")


def lever_weights(rows: DataFrame) -> DataFrame:
    """Of each reason: its candidates, and how much comparable_share would gain if all of them were compared."""
    total = Window.partitionBy()
    counts = rows.where("outcome <> 'compared'").groupBy(F.col("outcome").alias("reason")).agg(F.count("*").alias("candidates"))
    whole = rows.agg(F.count("*").alias("_all"))
    return counts.join(F.broadcast(whole)).withColumns({"share_of_refused": F.col("candidates") / F.sum("candidates").over(total), "lift": F.col("candidates") / F.col("_all")}).drop("_all")


def offsets(rows: DataFrame) -> DataFrame:
    """Contracts with an offset, and the compared rows that it accounts for."""
    kept = rows.where("contract_offset IS NOT NULL")
    return kept.groupBy("system", "facility", "carrier", "plan", "payer_label").agg(F.first("contract_offset").alias("offset"), F.count("*").alias("pairs"), F.count_if(F.col("explanation") == "systematic_offset").alias("reclassified"))


#: The published tables, each from the outcomes and the payer side.
TABLES = {
    "coverage": lambda rows, right: coverage(rows), "outcomes": lambda rows, right: outcomes(rows), "refusals": lambda rows, right: refusals(rows), "magnitude": lambda rows, right: magnitude(rows),
    "pairs": lambda rows, right: pairs(rows), "rates": rates, "measures": lambda rows, right: measures(rows), "offsets": lambda rows, right: offsets(rows),
    "exemplars": lambda rows, right: exemplars(rows), "residual": lambda rows, right: residual_top(rows),
}
