"""Which rule accounts for a residual row, and summaries of that queue."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratesmith.functions import numbers as N
from ratesmith.functions import text as X
from ratesmith.rules import tables as T

#: In order; the first that fires accounts for the row.
RULES = ["implausible", "vintage_artifact", "systematic_offset", "granularity_mismatch", "marginal", "unexplained"]


#: Buckets of the ratio's logarithm that a tolerance covers: what is counted in one task is a part of that.
_BUCKETS = 8


def _beside(rows: DataFrame, facts: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """rows with the other columns of facts (one row for each key); null keys are keys."""
    named = facts.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    on = reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys))
    return rows.join(named, on, how).drop(*(f"_k_{k}" for k in keys))


def near_counts(rows: DataFrame, keys: list[str], ratio: str = "ratio", tolerance: float = T.NEAR_TOLERANCE) -> DataFrame:
    """Adds near: how many rows of the same keys (itself included) have a ratio within the tolerance of this row's.

    A band join without pairs: for each distinct ratio the places of its bounds in the key's order. A place is the number of rows in
    lower buckets of the ratio's logarithm, and a running count within the bound's own bucket, so that no task has a whole key.
    """
    r, each = F.col(ratio), [*keys, "_bucket"]
    values = rows.where(r > 0).groupBy(*keys, r.alias("v")).agg(F.count("*").alias("c"))
    points = values.select(*keys, F.explode(F.array(
        F.struct(F.col("v").alias("x"), F.lit(1).alias("kind"), F.col("c").alias("c"), F.col("v")),
        F.struct((F.col("v") * (1 - tolerance)).alias("x"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("c"), F.col("v")),
        F.struct((F.col("v") * (1 + tolerance)).alias("x"), F.lit(2).alias("kind"), F.lit(0).cast("long").alias("c"), F.col("v")),
    )).alias("p")).select(*keys, "p.*").withColumn("_bucket", F.floor(F.log("x") * (_BUCKETS / math.log(1 + tolerance))))
    # rows at a bound count: the lower bound stands before them, the upper one after them
    run = Window.partitionBy(*each).orderBy("x", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = points.withColumn("_run", F.sum("c").over(run))
    below = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = points.groupBy(*each).agg(F.sum("c").alias("_n")).withColumn("_base", F.coalesce(F.sum("_n").over(below), F.lit(0))).drop("_n")
    at = _beside(placed, base, each, "inner").select(*keys, "v", (F.col("_base") + F.col("_run")).alias("_at"))
    near = at.groupBy(*keys, "v").agg((F.max("_at") - F.min("_at")).alias("near"))
    return _beside(rows.withColumn("v", r), near, [*keys, "v"]).drop("v").withColumn("near", F.coalesce("near", F.lit(0).cast("long")))


def queue(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Residual rows (rate, payer_median, plan, payer_label, vintage, payer_vintage) with rule and priority.

    Alike rows are told apart by the caller's columns; the queue's order is priority, then relative difference, widest first."""
    near = near_counts(rows, keys)
    sizes = rows.where("ratio > 0").groupBy(*keys).agg(F.count("*").alias("_size"))
    near = _beside(near, sizes, keys).withColumn("_size", F.coalesce("_size", F.lit(0)))
    days = N.days_apart(F.col("vintage"), F.col("payer_vintage"))
    stated = [X.folded(F.col(c)) != "" for c in ("plan", "payer_label")]
    fires = {
        "implausible": N.implausible(F.col("rate"), F.col("payer_median")),
        "vintage_artifact": days >= T.WIDE_DAYS,
        "systematic_offset": (F.col("_size") >= T.NEAR_CODES) & (F.col("near") >= T.NEAR_CODES),
        "granularity_mismatch": stated[0] != stated[1],
        "marginal": (F.col("relative_difference") > 0) & (F.col("relative_difference") < T.MARGINAL),
        "unexplained": F.lit(True),
    }
    rule = F.coalesce(*(F.when(fires[name], F.lit(name)) for name in RULES))
    out = near.withColumns({"gap_days": days, "rule": rule}).drop("_size")
    return out.withColumn("priority", F.array_position(F.array(*map(F.lit, RULES)), F.col("rule")).cast("int"))


def summary(q: DataFrame, keys: list[str]) -> DataFrame:
    """Findings by rule, and each rule's share of the keys' findings."""
    n = q.groupBy(*keys, "rule", "priority").agg(F.count("*").alias("findings"))
    return n.withColumn("share", F.col("findings") / F.sum("findings").over(Window.partitionBy(*keys)))


def service_groups(q: DataFrame) -> DataFrame:
    """Findings by code and carrier: where they point, how tight they are, and who has them."""
    out = q.groupBy("code", "carrier").agg(
        F.count("*").alias("findings"), F.median("ratio").alias("median_ratio"), F.count_if(F.col("ratio") > 1).alias("up"), F.count_if(F.col("ratio") < 1).alias("down"),
        N.ratio(F.max("ratio") - F.min("ratio"), F.median("ratio")).alias("spread"), F.countDistinct("facility").alias("facilities"),
    )
    m = F.greatest("median_ratio", 1 / F.col("median_ratio"))
    return out.withColumn("magnitude", m * (0.5 + 0.5 * F.least("findings", F.lit(5)) / 5))


def ordered(q: DataFrame) -> DataFrame:
    """The queue as it is worked off: by priority, then the widest first."""
    return q.orderBy("priority", F.desc("relative_difference"))
