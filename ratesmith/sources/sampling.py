"""Price files sampled by byte windows, so that a profile of a huge file costs some megabytes."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ranges
from .files import HEAD_BYTES, _head

WINDOWS, WINDOW_BYTES = 16, 2 << 20
_TEXT = pa.string()
_BODY = pa.schema([("file", _TEXT), ("size", pa.int64()), ("header", pa.list_(_TEXT)), ("body", pa.int64())])
_SAMPLE = pa.schema([("file", _TEXT), ("window", pa.int32()), ("row", pa.map_(_TEXT, _TEXT))])


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The header of each file, and the byte behind it."""
    for batch in batches:
        for row in batch.to_pylist():
            with ranges.opened(row["file"]) as raw:
                lines = raw.read(HEAD_BYTES).split(b"\n")
            at, found = 0, None
            for line in lines[:-1] if len(lines) > 1 else lines:
                at += len(line) + 1
                if found := _head(line.decode("utf-8", "replace").strip("\r"))["header"]:
                    break
            yield pa.RecordBatch.from_pylist([{**row, "header": found, "body": at if found else None}], _BODY)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole rows of each window that are as wide as the header; lines that the window's edges cut are left out."""
    for batch in batches:
        for row in batch.to_pylist():
            with ranges.opened(row["file"]) as raw:
                raw.seek(row["low"])
                text = raw.read(row["high"] - row["low"]).decode("utf-8", "replace")
            lines = text.split("\n")
            lines = lines[row["low"] > row["body"] : len(lines) if row["high"] >= row["size"] else -1]
            cells = [c for c in csv.reader(io.StringIO("\n".join(x for x in lines if x.strip()))) if len(c) == len(row["header"])]
            for i in range(0, len(cells), 1024):
                yield pa.RecordBatch.from_pylist([{"file": row["file"], "window": row["window"], "row": list(zip(row["header"], c, strict=True))} for c in cells[i : i + 1024]], _SAMPLE)


def sample_rows(files: DataFrame, windows: int = WINDOWS, window_bytes: int = WINDOW_BYTES) -> DataFrame:
    """(file, window, row) of CSV files (file, size): the rows of evenly spaced windows behind each header, row a map from column to
    cell. A file that the windows would cover is read whole, in one window. Files without a header have no rows; compressed ones
    can't be sampled. A window is one task's work, whatever the file's size."""
    spark = files.sparkSession
    heads = files.mapInArrow(_bodies, "file string, size long, header array<string>, body long").where("header IS NOT NULL")
    room = F.col("size") - F.col("body")
    small = room <= windows * window_bytes
    step = F.floor(room / windows).cast("long")
    each = heads.where(room > 0).withColumn("window", F.explode(F.when(small, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(windows - 1)))))
    low = F.col("body") + F.when(small, F.lit(0)).otherwise(F.col("window") * step)
    spans = each.withColumn("low", low.cast("long")).withColumn("high", F.when(small, F.col("size")).otherwise(F.least(F.col("size"), F.col("low") + window_bytes)).cast("long"))
    return spans.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file", "window").mapInArrow(_windows, "file string, window int, row map<string,string>")


def shares(sample: DataFrame, value: Column) -> DataFrame:
    """(file, value, lines, share, error) of a sample: each value's share of a file's rows, and the standard error of that share between
    the file's windows (null where there is one window, which is the whole file)."""
    each = sample.groupBy("file", "window", value.alias("value")).agg(F.count("*").alias("n"))
    size = sample.groupBy("file", "window").agg(F.count("*").alias("m"))
    whole = size.groupBy("file").agg(F.sum("m").alias("rows"), F.count("*").alias("windows"))
    both = size.join(each.select("file", "value").distinct(), "file").join(each, ["file", "window", "value"], "left").join(whole, "file")
    mean = F.sum(F.coalesce("n", F.lit(0))) / F.first("rows")
    spread = F.stddev_samp(F.coalesce("n", F.lit(0)) / F.col("m")) / F.sqrt(F.first("windows"))
    return both.groupBy("file", "value").agg(F.sum(F.coalesce("n", F.lit(0))).alias("lines"), mean.alias("share"), spread.alias("error"))
