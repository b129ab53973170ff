"""What Parquet files hold, from their footers, read by tasks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame

from . import ranges

_FOOTER = pa.schema([("file", pa.string()), ("size", pa.int64()), ("rows", pa.int64()), ("row_groups", pa.int64()), ("columns", pa.list_(pa.string())), ("first", pa.string()), ("sha256", pa.string()), ("error", pa.string())])


def _footers(first: str | None, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                out = {"file": row["file"], "size": row["size"], "rows": None, "row_groups": None, "columns": None, "first": None, "sha256": None, "error": None}
                with ranges.opened(row["file"]) as raw:
                    if digest:
                        h = hashlib.sha256()
                        while part := raw.read(1 << 20):
                            h.update(part)
                        out["sha256"] = h.hexdigest()
                        raw.seek(0)
                    try:
                        held = pq.ParquetFile(raw)
                        out |= {"rows": held.metadata.num_rows, "row_groups": held.metadata.num_row_groups, "columns": held.schema_arrow.names}
                        if first in out["columns"] and out["rows"]:
                            value = next(held.iter_batches(1, columns=[first])).column(0)[0].as_py()
                            out["first"] = None if value is None else str(value)
                    except pa.ArrowInvalid as e:  # a file that is cut off or no Parquet is reported, and the others are read
                        out["error"] = str(e)
                yield pa.RecordBatch.from_pylist([out], _FOOTER)

    return run


def footers(files: DataFrame, first: str | None = None, digest: bool = False) -> DataFrame:
    """(file, size, rows, row_groups, columns, first, sha256, error) of Parquet files (file, size). first: the first row's value of that
    column, as a string. digest: of all bytes, which are read for it; else only footers are. error: why a file isn't Parquet.

    Files are dealt to tasks, some hundred each; nothing is read on the driver."""
    parts = max(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), files.count() // 256)
    return files.select("file", "size").repartition(parts, "file").mapInArrow(_footers(first, digest), "file string, size long, rows long, row_groups long, columns array<string>, first string, sha256 string, error string")
