"""Partitioned tables: publish, verify, replace, list and compare."""

from __future__ import annotations

import atexit
import contextlib
import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ratesmith.functions import text as X


def conform(df: DataFrame) -> DataFrame:
    """hospital_slug and vintage recomputed, billing_class folded, blank as null."""
    return df.withColumns({"billing_class": X.blank_to_null(F.lower(F.col("billing_class"))), "hospital_slug": X.slug(F.col("hospital")), "vintage": X.partition_vintage(F.col("file_vintage"))})


def _fs(spark: SparkSession, path: str):
    """Hadoop's path and file system of a path, which needn't be local."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table's folder has any partition or file that readers see; a file is one itself."""
    where, fs = _fs(spark, path)
    return fs.exists(where) and any(not x.getPath().getName().startswith(("_", ".")) for x in fs.listStatus(where))


def _leaves(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Folders `depth` levels under path, relative to it, as they are named."""
    where, fs = _fs(spark, path)
    found = [""]
    for _ in range(depth):
        found = [f"{x}/{s.getPath().getName()}".lstrip("/") for x in found for s in fs.listStatus(_fs(spark, f"{path}/{x}")[0]) if s.isDirectory() and not s.getPath().getName().startswith(("_", "."))]
    return found


def publish(df: DataFrame, path: str, partitions: list[str], order: list[str] = (), rows_per_file: int = 5_000_000, owned: Callable[[str], bool] | None = None) -> int:
    """Replace the partitions that df has, and only those; the number of rows, checked against what was read back.

    owned: which partition folders, by their names under path, are the caller's; those of them that df has no rows for go.

    df is computed once: rows are counted while they are written to a folder beside the table, which Spark's readers skip; what was
    written is counted there, and only then its partitions take the place of the old ones. A null partition key is refused. Rows of
    one partition meet in few files: a shuffle by the keys and a salt of what AQE splits."""
    spark = df.sparkSession
    keyed = df
    for c in partitions:
        keyed = keyed.withColumn(c, F.when(F.col(c).isNotNull(), F.col(c)).otherwise(F.raise_error(F.lit(f"null in partition key {c}")).cast(df.schema[c].dataType)))
    seen = Observation(f"published-{uuid.uuid4().hex}")
    out = keyed.observe(seen, F.count(F.lit(1)).alias("rows")).hint("rebalance", *partitions)
    out = out.sortWithinPartitions(*partitions, *order) if order else out
    staging = f"{path}/_staging-{uuid.uuid4().hex}"
    try:
        out.write.option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).partitionBy(*partitions).parquet(staging)
        leaves = _leaves(spark, staging, len(partitions))
        # of an empty plan nothing is observed
        there, want = (spark.read.schema(df.schema).parquet(staging).count(), seen.get["rows"]) if leaves else (0, 0)
        if there != want:
            raise ValueError(f"{staging} holds {there} rows, not {want}: {path} is as it was")
        for leaf in set(_leaves(spark, path, len(partitions))) - set(leaves) if owned else ():
            if owned(leaf):
                where, fs = _fs(spark, f"{path}/{leaf}")
                fs.delete(where, True)
        for leaf in leaves:
            target, fs = _fs(spark, f"{path}/{leaf}")
            fs.delete(target, True)
            fs.mkdirs(target.getParent())
            if not fs.rename(_fs(spark, f"{staging}/{leaf}")[0], target):
                raise OSError(f"{path}/{leaf} couldn't be replaced")
        return there
    finally:
        where, fs = _fs(spark, staging)
        fs.delete(where, True)


def stale_partitions(spark: SparkSession, path: str, fresh: DataFrame, partitions: list[str], owned: Column) -> DataFrame:
    """Partitions under path that their owner has no rows for any more."""
    return spark.read.parquet(path).where(owned).select(*partitions).distinct().join(fresh.select(*partitions).distinct(), partitions, "left_anti")


def remove_partitions(spark: SparkSession, path: str, gone: DataFrame, partitions: list[str]) -> int:
    """Delete the folders of some partitions; how many went. Folders are taken from the files that hold the partitions, so it doesn't
    matter how their values are spelt there; there are few, one row each."""
    rows = spark.read.parquet(path)
    same = reduce(lambda x, y: x & y, (rows[c].eqNullSafe(gone[c]) for c in partitions))
    files = rows.withColumn("_at", F.regexp_replace(F.col("_metadata.file_path"), r"/[^/]*$", "")).join(gone.select(*partitions).distinct(), same, "left_semi").select("_at").distinct().collect()
    jvm, n = spark.sparkContext._jvm, 0
    for r in files:
        where = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r["_at"]))
        n += where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    return n


def manifest(spark: SparkSession, path: str, partitions: list[str] = ()) -> DataFrame:
    """One row a file: its name, rows, bytes and partition values."""
    rows = spark.read.option("mergeSchema", True).parquet(path)
    return rows.groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"), *partitions).agg(F.count("*").alias("rows"))


def verified_manifest(spark: SparkSession, path: str, expected: DataFrame, partitions: list[str], owned: Column) -> DataFrame:
    """Rows and bytes of each partition there, and whether a partition of one's own has the rows that were expected (null for others)."""
    found = manifest(spark, path, partitions).groupBy(*partitions).agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.count("*").alias("files"))
    want = expected.select(*(F.col(c).alias(f"_w_{c}") for c in partitions), F.col("rows").alias("_expected"))
    on = reduce(lambda x, y: x & y, (F.col(c).cast("string").eqNullSafe(F.col(f"_w_{c}").cast("string")) for c in partitions))
    return found.join(want, on, "left").withColumn("verified", F.when(owned, F.coalesce(F.col("rows") == F.col("_expected"), F.lit(False)))).select(*partitions, "files", "rows", "bytes", "verified")


def manifest_diff(before: DataFrame, after: DataFrame, keys: list[str], value: str) -> DataFrame:
    """missing, unexpected, changed or same for each key of either side; null keys match each other."""
    a = before.select(*(F.col(k).alias(f"_a_{k}") for k in keys), F.col(value).alias("expected"), F.lit(True).alias("_in_a"))
    b = after.select(*keys, F.col(value).alias("observed"), F.lit(True).alias("_in_b"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"_a_{k}").eqNullSafe(F.col(k))
    both = a.join(b, on, "full")
    status = F.when(F.col("_in_b").isNull(), "missing").when(F.col("_in_a").isNull(), "unexpected").when(F.col("expected").eqNullSafe(F.col("observed")), "same").otherwise("changed")
    return both.select(*(F.when(F.col("_in_b").isNull(), F.col(f"_a_{k}")).otherwise(F.col(k)).alias(k) for k in keys), "expected", "observed", status.alias("status"))


def gate(verdict: dict | None, age_days: float, stale_after: float = 3.0) -> str:
    """missing, stale, failed or passed, from the last check's verdict."""
    return "missing" if verdict is None else "stale" if age_days > stale_after else "passed" if verdict.get("ok") else "failed"


def audit(spark: SparkSession, path: str, entry: dict) -> None:
    """One more line in the log of loads: the entry as JSON."""
    spark.createDataFrame([(json.dumps(entry, sort_keys=True, default=str),)], "value string").coalesce(1).write.mode("append").text(path)


def release_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Files of a release with bytes, rows and the SHA-256 of their content. Release files are summary tables of some MB."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    sums = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select(name.alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    rows = spark.read.option("mergeSchema", True).parquet(path).groupBy(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1).alias("file")).agg(F.count("*").alias("rows"))
    return sums.join(rows, "file", "left").fillna(0, ["rows"])


def rotate(df: DataFrame, path: str, stamp: str, keep: int = 5) -> list[str]:
    """Write a snapshot as path/snapshot=<stamp> and drop all but the last `keep`; the names of those that stay, oldest first."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}/snapshot={stamp}")
    names = sorted(x for x in _leaves(spark, path, 1) if x.startswith("snapshot="))
    for name in names[:-keep]:
        where, fs = _fs(spark, f"{path}/{name}")
        fs.delete(where, True)
    return names[-keep:]


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    names = sorted(x for x in _leaves(spark, path, 1) if x.startswith("snapshot="))
    return spark.read.parquet(f"{path}/{names[-1]}") if names else None


def write_status(spark: SparkSession, path: str, verdict: dict) -> None:
    spark.createDataFrame([(json.dumps(verdict, sort_keys=True, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_status(spark: SparkSession, path: str) -> dict | None:
    where, fs = _fs(spark, path)
    lines = spark.read.text(path).limit(1).collect() if fs.exists(where) else []
    return json.loads(lines[0]["value"]) if lines else None


def run_manifest(spark: SparkSession, layers: dict[str, tuple[DataFrame, DataFrame]], keys: list[str], value: str, status: str, at: str) -> dict:
    """Compare each layer's expected rows with those there; the verdict, which is also written to `status`. ok: all are the same."""
    wrong = {name: manifest_diff(want, there, keys, value).where("status <> 'same'").groupBy("status").agg(F.count("*").alias("n")).collect() for name, (want, there) in layers.items()}  # a row for each status
    verdict = {"at": at, "layers": {name: {r["status"]: r["n"] for r in rows} for name, rows in wrong.items()}}
    verdict["ok"] = not any(verdict["layers"].values())
    write_status(spark, status, verdict)
    return verdict


def select_systems(systems: DataFrame, only: str) -> DataFrame:
    """The system with this slug or either of its names, small letters or large; all if blank; an unknown name is an error.

    systems: slug, name, other_name; a row for each system."""
    if not only.strip():
        return systems
    want = F.lit(only.strip().lower())
    found = systems.where(reduce(lambda x, y: x | y, (F.lower(c) == want for c in ("slug", "name", "other_name"))))
    if not found.limit(1).count():
        raise ValueError(f"no system is called {only}")
    return found


def merged(frames: list[DataFrame]) -> DataFrame:
    """Tables with different columns as one; what a table lacks is null."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def to_csv(df: DataFrame, path: str) -> None:
    """A summary table as one CSV file, rows ordered by the text of every column."""
    df.orderBy(*(F.col(c).cast("string") for c in df.columns)).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


_working: dict[str, SparkSession] = {}


def working_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share. It goes when Python ends."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.sql.warehouse.dir") + "/_work"
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _working[path] = spark
    return path


def file_states(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, int]]:
    """(path, length, time of change) of all files below some paths, in order."""
    out = []
    for path in paths:
        where, fs = _fs(spark, path)
        files = fs.listFiles(where, True)
        while files.hasNext():
            f = files.next()
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


def working_table(df: DataFrame, name: str) -> str:
    """Write df to a working path, which also cuts its lineage; the path."""
    path = working_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return path


@atexit.register
def _drop_working() -> None:
    with contextlib.suppress(Exception):
        for path, spark in _working.items():
            where, fs = _fs(spark, path)
            fs.delete(where, True)
