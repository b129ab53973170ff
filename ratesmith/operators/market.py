"""Ranks, spreads and look-ups among facilities and carriers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratesmith.functions import numbers as N


def peer_rank(rates: DataFrame, keys: list[str], rate: str = "rate", reliable: int = 5) -> DataFrame:
    """Each row's share of peers at or below it, and the peers' spread; reliable with enough peers."""
    w = Window.partitionBy(*keys)
    out = {"percentile": F.cume_dist().over(w.orderBy(rate)), "peer_median": F.median(rate).over(w), "peer_min": F.min(rate).over(w), "peer_max": F.max(rate).over(w), "peers": F.count("*").over(w)}
    return rates.withColumns(out).withColumn("reliable", F.col("peers") >= reliable)


def spreads(rates: DataFrame, keys: list[str], rate: str = "rate", facility: str = "facility") -> DataFrame:
    out = rates.groupBy(*keys).agg(
        F.min(rate).alias("low"), F.min_by(facility, F.struct(rate, facility)).alias("low_facility"), F.max(rate).alias("high"),
        F.min_by(facility, F.struct(-F.col(rate), F.col(facility))).alias("high_facility"), F.median(rate).alias("median_rate"),
    )
    return out.withColumn("ratio", N.ratio(F.col("high"), F.col("low")))


def opportunity(ranked: DataFrame, target: float, cases: Column, rate: str = "rate") -> DataFrame:
    """What rows under the target percentile would gain at their peers' median."""
    return ranked.withColumn("opportunity", F.when(F.col("percentile") < target, F.greatest(F.col("peer_median") - F.col(rate), F.lit(0.0)) * cases).otherwise(0.0))


def rankings(rows: DataFrame, by: str, ties: list[str]) -> DataFrame:
    """A global rank by the size of a column, rows without it last. One small table of entities, not of rates."""
    size = F.coalesce(F.abs(by), F.lit(-1.0))
    return rows.withColumn("rank", F.row_number().over(Window.orderBy(size.desc(), *ties)))


def head_to_head(rows: DataFrame, keys: list[str], rate: str = "rate", far: float = 3.0) -> DataFrame:
    """Against the lowest and the median of a group."""
    w = Window.partitionBy(*keys)
    low, mid = F.min(rate).over(w), F.median(rate).over(w)
    out = rows.withColumns({"vs_lowest": N.ratio(F.col(rate), low), "vs_median": N.ratio(F.col(rate), mid), "is_lowest": F.col(rate) == low})
    return out.withColumn("far", (F.col("vs_median") >= far) | ((F.col("vs_median") > 0) & (F.col("vs_median") <= 1 / far)))


def scorecard(rows: DataFrame, code: str, facility: str, rate: str = "rate") -> DataFrame:
    """Per facility: the median of its rates' ratios to each code's median, codes where it is the lowest, codes."""
    w = Window.partitionBy(code)
    r = rows.withColumns({"_ratio": N.ratio(F.col(rate), F.median(rate).over(w)), "_win": F.col(rate) == F.min(rate).over(w)})
    return r.groupBy(facility).agg(F.median("_ratio").alias("index"), F.count_if("_win").alias("wins"), F.count("*").alias("published"))


def tier_ratios(rows: DataFrame, keys: list[str], network: str, tier: str, standard: str, rate: str = "rate") -> DataFrame:
    """Rates of two networks for one key, where each has a single value."""
    one = rows.where(F.col(network).isin(tier, standard)).groupBy(*keys).agg(*(x for name, n in (("tier", tier), ("standard", standard)) for x in (F.countDistinct(F.when(F.col(network) == n, F.col(rate))).alias(f"_{name}"), F.min(F.when(F.col(network) == n, F.col(rate))).alias(f"{name}_rate"))))
    return one.where("_tier = 1 AND _standard = 1").drop("_tier", "_standard").withColumn("ratio", N.ratio(F.col("tier_rate"), F.col("standard_rate")))


def cell_ranges(rows: DataFrame, keys: list[str], rate: str = "rate", label: str = "setting") -> DataFrame:
    """Least and largest rate, distinct rates, and the labels of each cell."""
    labels = F.array_sort(F.collect_set(label))
    return rows.groupBy(*keys).agg(F.min(rate).alias("low"), F.max(rate).alias("high"), F.countDistinct(rate).alias("n_rates"), F.array_join(labels, ",").alias("labels"))


def wide(rows: DataFrame, key: str, column: str, values: list, value: Column) -> DataFrame:
    """One column for each named value, in that order."""
    return rows.groupBy(key).pivot(column, values).agg(value)


def cross_check(a: DataFrame, b: DataFrame, keys: list[str], rate: str = "rate") -> DataFrame:
    """A full outer comparison: which side has a key, and the ratio where both do."""
    out = a.select(*keys, F.col(rate).alias("a_rate")).join(b.select(*keys, F.col(rate).alias("b_rate")), keys, "full")
    found = F.when(F.col("b_rate").isNull(), "a only").when(F.col("a_rate").isNull(), "b only").when(F.col("a_rate") == F.col("b_rate"), "equal").otherwise("differ")
    return out.withColumns({"found": found, "ratio": F.when(F.col("a_rate").isNotNull() & F.col("b_rate").isNotNull(), N.ratio(F.col("a_rate"), F.col("b_rate")))})


def confusion(rows: DataFrame, actual: str, predicted: str) -> DataFrame:
    return rows.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def scores(rows: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and coverage of a boolean prediction; null is no prediction."""
    a, p = F.col(actual), F.coalesce(F.col(predicted), F.lit(False))
    n = rows.agg(F.count_if(a & p).alias("tp"), F.count_if(~a & p).alias("fp"), F.count_if(a & ~p).alias("fn"), F.count_if(~a & ~p).alias("tn"), (F.count(predicted) / F.count("*")).alias("coverage"))
    share = lambda x, *y: N.ratio(x.cast("double"), sum(y, F.lit(0.0)))
    tp, fp, fn = (F.col(c) for c in ("tp", "fp", "fn"))
    return n.withColumns({"precision": share(tp, tp, fp), "recall": share(tp, tp, fn), "f1": share(2 * tp, 2 * tp, fp, fn)})
