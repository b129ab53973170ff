"""Ingest of landed files as a stream: every file once, curated rows and rejects apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratesmith.operators.conform import curate, newest_of_source


def ingest(spark: SparkSession, landing: str, schema: str, target: str, checkpoint: str) -> None:
    """Curate what has landed since the last run and stop. A batch is written as its own partition, so a batch that is run again
    after a failure replaces itself; row_hash drops rows that repeat within it. What holds now is current()."""
    raw = spark.readStream.schema(schema).parquet(landing)

    def write(batch: DataFrame, number: int) -> None:
        out = curate(batch).dropDuplicates(["row_hash"])
        for name, rows in (("curated", out.where("reject IS NULL")), ("rejects", out.where("reject IS NOT NULL"))):
            rows.write.mode("overwrite").parquet(f"{target}/{name}/batch={number}")

    raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def current(spark: SparkSession, target: str) -> DataFrame:
    """The curated rows of each source's newest batch, and of rows that came again in one source only that one."""
    return newest_of_source(spark.read.parquet(f"{target}/curated").withColumn("batch", F.col("batch").cast("long")), "source_url", "batch")
