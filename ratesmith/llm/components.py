"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, saved


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's larger (or its smaller) neighbours on its least one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    rows = near.join(least, "a")
    out = rows.where("b > a" if large else "b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if large:  # small stars come next, which tell repeated edges apart
        return out.where("a <> b")
    return out.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label): the least node of each node's component, for all nodes of edges (a, b); loops and repeated edges do no harm.

    Large and small stars in turn until every node hangs on its component's least; each round's edges are a working table.
    """
    now, before = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name), None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if seen["n"] == 0 or seen == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label"))
        before, last = seen, now
        now = saved(_stars(_stars(last, large=True), large=False), name)
        forget(last)
