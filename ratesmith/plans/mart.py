"""The mart run: outcomes once, all published tables from them, each a commit that replaces partitions, and what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratesmith.operators import compare, gold
from ratesmith.sources import versions

#: Tables that have no system of their own are published whole, under one value.
WHOLE = "all"


def run_mart(spark: SparkSession, left: DataFrame, right: DataFrame, path: str, **join) -> DataFrame:
    """Publish all tables of gold.TABLES under path/<table>, partitioned by hospital_slug (the system); (table, hospital_slug, rows).

    The comparison runs once, into working tables that all tables are made from. Only the systems of `left` are replaced, and those
    of them that have no rows of a table any more lose their partition there. A table is published by one commit (versions.py): a run
    that breaks off leaves each table as it was or as it should be, and readers never see a mixture.
    """
    outcomes = compare.with_offsets(compare.explain(compare.distribution_join(left, right, **join)), written=True)
    owned = {r["s"] for r in outcomes.select(F.col("system").cast("string").alias("s")).distinct().collect()}  # a row for each system
    entries = spark.createDataFrame([], "table string, hospital_slug string, rows long")
    for name, make in gold.TABLES.items():
        table = make(outcomes, right)
        slug = F.col("system").cast("string") if "system" in table.columns else F.lit(WHOLE)
        versions.commit(table.withColumn("hospital_slug", slug), f"{path}/{name}", ["hospital_slug"], owned={(x,) for x in owned})
        mine = versions.read(spark, f"{path}/{name}").where(F.col("hospital_slug").isin([*owned, WHOLE]))
        entries = entries.unionByName(mine.groupBy("hospital_slug").agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "hospital_slug", "rows"))
    return entries
