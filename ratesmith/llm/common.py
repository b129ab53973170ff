"""Working tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_left: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a folder of the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return base.rstrip("/") if base else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of a few MB, where the session has the default of 64: they are held several times over in JVM and Python."""
    if spark.conf.get(_BATCH_BYTES, "67108864b") == "67108864b":
        spark.conf.set(_BATCH_BYTES, "4194304b")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder. It goes when Python ends, or earlier by drop()."""
    small_batches(spark)
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _left[path] = spark
    return path


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of a folder's files and folders."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return [x.getPath().getName() for x in where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(where)]


def drop(spark: SparkSession, *paths: str) -> None:
    """Delete working tables that nothing reads any more."""
    for path in paths:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        _left.pop(path, None)


@atexit.register
def _drop_left() -> None:
    with contextlib.suppress(Exception):
        for path, spark in list(_left.items()):
            drop(spark, path)


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession):
    """Shuffle files of the writes inside go as soon as each write has ended, not when the driver collects garbage."""
    before = spark.conf.get(_FREE_SHUFFLES, "false")
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)


def write_table(df: DataFrame, name: str, compression: str = "zstd") -> str:
    """Write a working table, which also cuts the lineage; its path."""
    path = work_path(df.sparkSession, name)
    with freed_shuffles(df.sparkSession):
        df.write.option("compression", compression).parquet(path)
    return path


def saved(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """The rows of df, from a working table that has just been written."""
    spark, schema = df.sparkSession, df.schema
    path = write_table(df, name, compression)
    out = spark.read.schema(schema).parquet(path)
    out.work_path = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables of saved() that nothing reads any more."""
    for df in tables:
        drop(df.sparkSession, df.work_path)


#: A key is hot that holds more than one in so many rows; so there are fewer hot keys than this.
HOT_SHARE = 1000


def spread_join(rows: DataFrame, facts: DataFrame, key: str, total: int) -> DataFrame:
    """Left join of rows with facts (one row for each key, with n_rows, the key's rows), so that no key gathers in one task.

    Facts of hot keys are broadcast: fewer than HOT_SHARE rows, whatever the input. Rows without a key meet nobody.
    """
    hot = facts.where(F.col("n_rows") * HOT_SHARE > total).drop("n_rows")
    cold = facts.where(F.col("n_rows") * HOT_SHARE <= total).drop("n_rows")
    known = rows.where(F.col(key).isNotNull())
    alone = rows.where(F.col(key).isNull()).withColumns({f.name: F.lit(None).cast(f.dataType) for f in cold.schema if f.name != key})
    names = [*rows.columns, *(c for c in cold.columns if c != key)]
    parts = known.join(F.broadcast(hot), key), known.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key, "left"), alone
    return parts[0].select(*names).unionByName(parts[1].select(*names)).unionByName(parts[2].select(*names))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts, for the numbers of buckets and partitions."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0)).alias("n")).first()["n"]


def parts_for(spark: SparkSession, n_bytes: int, each: int = 16 << 20) -> int:
    """Partitions of about `each` bytes, and never fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // each))
