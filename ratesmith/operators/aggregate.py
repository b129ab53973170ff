"""Exact aggregates per key with total orders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


def median_by_key(df: DataFrame, keys: list[str], value: str = "rate", **more: Column) -> DataFrame:
    """The exact median of the values that aren't null, and their number; null keys are keys.

    Rows of a key are sorted, which spills: most keys have few rows, for which the state of a median is larger than they are. A hash
    of the keys stands before them, so that rows are told apart by one number. Nulls come first, the row below the middle stays."""
    w = Window.partitionBy("_h", *keys)
    ordered, n = w.orderBy(value), F.col("_n")
    rows = df if "_h" in df.columns else df.withColumn("_h", F.xxhash64(*keys))
    rows = rows.withColumns({"_i": F.row_number().over(ordered), "_next": F.lead(value).over(ordered), "_n": F.count(value).over(w), "_all": F.count("*").over(w), **{k: c.over(w) for k, c in more.items()}})
    low = F.col(value).cast("double")
    high = F.when(n % 2 == 0, F.col("_next").cast("double")).otherwise(low)
    return rows.where(F.col("_i") == F.col("_all") - n + F.floor((n + 1) / 2)).select(*keys, (low * 0.5 + high * 0.5).alias(value), n.alias("n"), *more)


def distinct_then_median(df: DataFrame, columns: list[str], keys: list[str], value: str = "rate") -> DataFrame:
    """Rows go to the task of their keys' hash first, so that both steps need one shuffle."""
    return median_by_key(df.select(*columns).withColumn("_h", F.xxhash64(*keys)).repartition("_h").distinct(), keys, value)


def median_row(df: DataFrame, keys: list[str], order: list[Column], upper: bool) -> DataFrame:
    """The row in the middle of each key's order; of two, the upper or the lower."""
    n = F.count("*").over(Window.partitionBy(*keys))
    at = F.floor(n / 2) + 1 if upper else F.ceil(n / 2)
    return df.withColumns({"_i": F.row_number().over(Window.partitionBy(*keys).orderBy(*order)), "_at": at}).where("_i = _at").drop("_i", "_at")


def first_rows(df: DataFrame, keys: list[str], order: list[Column], n: int = 1, rank: str = "rank") -> DataFrame:
    """The first n rows of each key; the order must be total."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= n)


def most_frequent(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Each key's most frequent value, of ties the least. The counts are small: one row for each key and value."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    return counts.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(value))


#: A key is hot that holds more than one in so many rows, so there are fewer hot keys than this; and rows that it has at least.
HOT_SHARE, HOT_ROWS = 1000, 100_000
#: Values of a key that percentile_approx tells apart; its error in places is one in so many.
ACCURACY = 10_000


def order_statistics(df: DataFrame, keys: list[str], value: str, places: dict[str, Column]) -> DataFrame:
    """The exact values at some places of each key's order: a row for each key that has values, with its keys and a column for each of
    `places`, whose places (from 1) are expressions over the number of values, `_n`.

    Keys of few rows are ranked by a spillable window. A hot key spreads over all tasks: an approximate percentile gives two values
    between which the place must be, rows below are counted and rows between summed up by value, both before anything is shuffled,
    and the place is found among those sums. Null values don't count; a null key is a key. What is read twice should be a table.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    total = sizes.agg(F.sum("_n").alias("n")).first()["n"] or 0
    hot = [r.asDict() for r in sizes.where((F.col("_n") * HOT_SHARE > total) & (F.col("_n") >= HOT_ROWS)).collect()]  # fewer than HOT_SHARE rows
    same = lambda a, b: reduce(lambda x, y: x & y, (a[k].eqNullSafe(b[k]) for k in keys), F.lit(True))
    big = F.broadcast(df.sparkSession.createDataFrame([tuple(r[k] for k in [*keys, "_n"]) for r in hot], sizes.schema)) if hot else None
    cold = rows.join(big, same(rows, big), "left_anti") if hot else rows
    w = Window.partitionBy(*keys)
    ranked = cold.withColumns({"_n": F.count("*").over(w), "_i": F.row_number().over(w.orderBy("_v"))})
    at = {f"_at_{name}": place.cast("long") for name, place in places.items()}
    out = ranked.withColumns(at).groupBy(*keys).agg(*(F.max(F.when(F.col("_i") == F.col(f"_at_{name}"), F.col("_v"))).alias(name) for name in places))
    if not hot:
        return out
    mine = rows.join(big.select(*keys), same(rows, big), "left_semi")
    wanted = big.withColumns(at)
    for name in places:
        near = lambda side: F.least(F.greatest(F.col(f"_at_{name}") / F.col("_n") + side * 3 / ACCURACY, F.lit(0.0)), F.lit(1.0))  # noqa: B023, E731
        bounds = [r.asDict() for r in wanted.select(*keys, near(-1).alias("low"), near(1).alias("high")).collect()]
        between = []
        for r in bounds:  # a percentile needs a constant share; hot keys are few, and all go in one pass below
            own = reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.lit(r[k])) for k in keys), F.lit(True))
            between.append(F.percentile_approx(F.when(own, F.col("_v")), [r["low"], r["high"]], ACCURACY))
        edges = mine.agg(F.array(*between).alias("e")).first()["e"]
        spans = F.broadcast(df.sparkSession.createDataFrame([(*(r[k] for k in keys), float(e[0]), float(e[1])) for r, e in zip(bounds, edges, strict=True)], _span_schema(sizes, keys)))
        seen = mine.join(spans, same(mine, spans)).select(*(mine[k] for k in keys), "_v", "_low", "_high").where("_v <= _high")
        sums = seen.groupBy(*keys, F.when(F.col("_v") >= F.col("_low"), F.col("_v")).alias("_v")).agg(F.count("*").alias("_c"))  # those below are one sum
        below = F.sum("_c").over(w.orderBy(F.asc_nulls_first("_v")).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        upto = sums.withColumn("_upto", below)
        found = upto.join(wanted, same(upto, wanted)).where(F.col("_upto") >= F.col(f"_at_{name}")).groupBy(*(upto[k] for k in keys)).agg(F.min("_v").alias(name))
        place = found if name == next(iter(places)) else place.join(found, same(place, found)).select(*(place[k] for k in keys), *(c for c in place.columns if c not in keys), name)
    return out.unionByName(place)


def _span_schema(sizes: DataFrame, keys: list[str]) -> StructType:
    return StructType([*(f for f in sizes.schema if f.name in keys), StructField("_low", DoubleType()), StructField("_high", DoubleType())])


def exact_median(df: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    """The exact median of each key, as order_statistics finds it."""
    n = F.col("_n")
    two = order_statistics(df, keys, value, {"_lower": F.floor((n + 1) / 2), "_upper": F.floor(n / 2) + 1})
    return two.select(*keys, ((F.col("_lower") + F.col("_upper")) / 2).alias(name))


def _nth(df: DataFrame, keys: list[str], value: str, at: Column) -> DataFrame:
    """The value at a 1-based place of each key's order."""
    return order_statistics(df, keys, value, {"p90": at})


def p90_nearest(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The value at place round(0.9 n), halves to even."""
    return _nth(df, keys, value, F.greatest(F.lit(1), F.least("_n", F.bround(F.col("_n") * F.lit("0.9").cast("decimal(2,1)")))))


def p90_floor(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The value at place floor(0.9 n) + 1."""
    return _nth(df, keys, value, F.least("_n", F.floor(F.col("_n") * F.lit("0.9").cast("decimal(2,1)")) + 1))
