"""Substring dedup: a log-structured index of window fingerprints, against which documents come in batches.

The index is a list of sorted immutable runs. A run is a table bucketed by the fingerprint's high bits, one row for each
bucket with its sorted fingerprints; a batch is merge-joined with the runs bucket by bucket, its own new fingerprints become
one more run, and runs of like size are merged into one (compaction). A match is verified by a second, independent hash that is
kept beside each fingerprint, so that 96 bits of two hash families have to agree. Both have a secret key that is drawn for each
index, so that no words can be made that agree. A manifest names the runs and holds the key, so that an index can be opened again
and take further batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop, exists, freed_shuffles, names_in, parts_for, saved, small_batches, table, work_path
from .shingles import Words, by_bucket, give_back, mix, new_key, text_slices, windows, words

WINDOW = 13
BATCHES = 3
#: Runs of one level that are merged into a run of the next.
FANOUT = 2
RUN = "bucket int, n long, gaps binary, checks binary"
BATCH = ["bucket", "n", "gaps", "checks", "part", "fps", "ids", "kind"]
#: What a row of a run's table is; each kind is a folder of its own.
HITS, WINDOWS = 0, 1


def _planes(x: np.ndarray) -> bytes:
    """Bytes of integers by place, so that the high bytes of small gaps compress to nothing."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unplanes(raw: pa.Buffer) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _run_row(bucket: int, fps: np.ndarray, checks: np.ndarray) -> pa.Table:
    gaps = np.diff(fps, prepend=np.uint64(0))
    return pa.table({"bucket": pa.array([bucket], pa.int32()), "n": [len(fps)], "gaps": pa.array([_planes(gaps)], pa.binary()), "checks": pa.array([checks.astype("<u4").tobytes()], pa.binary())})


def _run_of(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All (fingerprint, check) of a bucket's rows of one or more runs, sorted."""
    fps = [np.cumsum(_unplanes(x.as_buffer()), dtype=np.uint64) for x in t.column("gaps")]
    checks = [np.frombuffer(x.as_buffer(), "<u4") for x in t.column("checks")]
    if not fps:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    f, c = np.concatenate(fps), np.concatenate(checks)
    if len(fps) > 1:
        order = np.lexsort((c, f))
        f, c = f[order], c[order]
    return f, c


def _compacted(key: tuple[pa.Scalar, ...], one: pa.Table, other: pa.Table) -> pa.Table:
    return _run_row(key[0].as_py(), *_run_of(pa.concat_tables([one, other])))


def _held(f: np.ndarray, c: np.ndarray, fps: np.ndarray, checks: np.ndarray) -> np.ndarray:
    """Which of (f, c) stand in the sorted (fps, checks): a merge of two sorted lists."""
    hit = np.zeros(len(f), bool)
    at, stop = np.searchsorted(fps, f, "left"), len(fps)
    open_ = np.flatnonzero(at < stop)
    while len(open_):
        open_ = open_[fps[at[open_]] == f[open_]]
        hit[open_] |= checks[at[open_]] == c[open_]
        at[open_] += 1
        open_ = open_[(at[open_] < stop) & ~hit[open_]]
    return hit


def _by_part(f: np.ndarray, c: np.ndarray, d: np.ndarray, parts: int) -> tuple[list[int], list[list[bytes]]]:
    """The parts of some hits' documents, and each part's fingerprints, checks and ids."""
    order, held, cuts = by_bucket(part_of(d, parts))
    return held.tolist(), [[x[order][i:j].tobytes() for i, j in zip(cuts, cuts[1:], strict=False)] for x in (f, c, d)]


def _window_hashes(w: Words, window: int, key: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint, check, text and first word of each window."""
    f, text, at = windows(w.keyed_hashes(key), w.first, window, key=key)
    return f, windows(w.keyed_hashes(key, 1), w.first, window, seed=1, key=key)[0].astype(np.uint32), text, at


def _fingerprints(window: int, buckets: int, parts: int, key: bytes):
    """(bucket, fingerprints, checks, doc_ids) of the windows of each slice of documents. A window comes once from a slice, with the
    least of its documents; that the others have it too goes to buckets -1 and down, by part of the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_slices(batch):
                w = words(batch.column("text").slice(a, b - a))
                f, c, text, _ = _window_hashes(w, window, key)
                d = batch.column("doc_id").slice(a, b - a).to_numpy(zero_copy_only=False)[text].astype(np.int64)
                order = np.lexsort((d, c, f))
                f, c, d = f[order], c[order], d[order]
                new = np.r_[True, (f[1:] != f[:-1]) | (c[1:] != c[:-1])] if len(f) else np.zeros(0, bool)
                more = (d > d[new][np.cumsum(new) - 1]) if len(f) else new
                bucket = (f[new] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
                _, held, cuts = by_bucket(bucket)  # fingerprints are in order, so are buckets
                own = [[x[new][i:j].tobytes() for i, j in zip(cuts, cuts[1:], strict=False)] for x in (f, c, d)]
                part, hits = _by_part(f[more], c[more], d[more], parts)
                yield pa.RecordBatch.from_arrays([pa.array([*held.tolist(), *(-1 - x for x in part)], pa.int32()), *(pa.array([*x, *y], pa.binary()) for x, y in zip(own, hits, strict=True))], ["bucket", "fps", "checks", "ids"])

    return run


def _merge(parts: int):
    """Join a batch's bucket with the index's: hits by part of doc_id, and the bucket's new fingerprints as a run's row (part -1)."""

    def run(key: tuple[pa.Scalar, ...], batch: pa.Table, index: pa.Table) -> pa.Table:
        give_back()
        bucket = key[0].as_py()
        join = lambda c, kind: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in batch.column(c)] or [np.zeros(0, kind)])
        f, c, d = join("fps", "<u8"), join("checks", "<u4"), join("ids", "<i8")
        row = None
        if bucket >= 0:
            order = np.lexsort((d, c, f))
            f, c, d = f[order], c[order], d[order]
            new = np.r_[True, (f[1:] != f[:-1]) | (c[1:] != c[:-1])] if len(f) else np.zeros(0, bool)
            at = np.cumsum(new) - 1
            known = _held(f[new], c[new], *_run_of(index))
            hit = known[at] | (d > d[new][at]) if len(f) else new
            fresh = np.flatnonzero(new)[~known]
            row = _run_row(bucket, f[fresh], c[fresh]) if len(fresh) else None
            f, c, d = f[hit], c[hit], d[hit]
        part, hits = _by_part(f, c, d, parts)
        out = pa.table({"bucket": pa.array([bucket] * len(part), pa.int32()), "part": pa.array(part, pa.int32()), **{name: pa.array(x, pa.binary()) for name, x in zip(("fps", "checks", "ids"), hits, strict=True)}, "kind": pa.array([HITS] * len(part), pa.int32())})
        out = out.append_column("n", pa.nulls(len(part), pa.int64())).append_column("gaps", pa.nulls(len(part), pa.binary())).select(BATCH)
        if row is None:
            return out
        row = row.append_column("part", pa.nulls(1, pa.int32())).append_column("fps", pa.nulls(1, pa.binary())).append_column("ids", pa.nulls(1, pa.binary())).append_column("kind", pa.array([WINDOWS], pa.int32()))
        return pa.concat_tables([out, row.select(BATCH)])

    return run


def part_of(ids: np.ndarray, parts: int) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) >> np.uint64(33)) % np.uint64(parts)


def by_document(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """One row for each document of a part, with its fingerprints and their checks."""
    f, c, d = (np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in t.column(name)]) for name, kind in (("fps", "<u8"), ("checks", "<u4"), ("ids", "<i8")))
    order = np.lexsort((c, f, d))
    f, c, d = f[order], c[order], d[order]
    cuts = np.r_[np.flatnonzero(np.r_[True, d[1:] != d[:-1]]), len(d)]
    ranges = list(zip(cuts, cuts[1:], strict=False))
    return pa.table({"id": d[cuts[:-1]], "hits": pa.array([f[i:j].tobytes() for i, j in ranges], pa.binary()), "hit_checks": pa.array([c[i:j].tobytes() for i, j in ranges], pa.binary())})


_HITS = "part int, fps binary, checks binary, ids binary"


class WindowIndex:
    """Fingerprints of all windows seen so far, in runs of FANOUT-fold levels. Runs are bucketed tables, so that merges move no rows.

    The index lives in the folder `path`. Each change of its runs writes a new manifest beside the old one; open() reads the latest.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int, window: int = WINDOW, key: bytes | None = None):
        self.spark, self.path, self.buckets, self.window, self.version, self.key = spark, path, buckets, window, 0, key or new_key()
        self.runs: list[tuple[int, str, int]] = []
        self.files = int(spark.conf.get("spark.sql.shuffle.partitions"))

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> WindowIndex:
        """The index that an earlier session has left in `path`."""
        last = max((n for n in names_in(spark, path) if n.startswith("manifest-") and exists(spark, f"{path}/{n}/_SUCCESS")), key=lambda n: int(n.split("-")[1]))
        rows = spark.read.schema("buckets int, window int, level int, name string, files int, key binary").parquet(f"{path}/{last}").collect()  # one row for each run
        out = cls(spark, path, rows[0]["buckets"], rows[0]["window"], bytes(rows[0]["key"]))
        out.version = int(last.split("-")[1])
        for r in rows:
            if r["name"]:
                spark.sql(f"CREATE TABLE IF NOT EXISTS {r['name']} ({RUN}, part int, fps binary, ids binary, kind int) USING parquet PARTITIONED BY (kind) CLUSTERED BY (bucket) INTO {r['files']} BUCKETS LOCATION '{path}/{r['name']}'")
                spark.sql(f"MSCK REPAIR TABLE {r['name']}")
                out.runs.append((r["level"], r["name"], r["files"]))
        return out

    def _write(self, df: DataFrame, level: int) -> str:
        """A run's table, bucketed as its rows are dealt already."""
        name = f"window_run_{uuid.uuid4().hex}"
        with freed_shuffles(self.spark):
            df.write.format("parquet").option("compression", "zstd").option("path", f"{self.path}/{name}").partitionBy("kind").bucketBy(self.files, "bucket").saveAsTable(name)
        self.runs.append((level, name, self.files))
        return f"{self.path}/{name}"

    def _read(self, run: tuple) -> DataFrame:
        return self.spark.table(run[1]).where(f"kind = {WINDOWS}").select("bucket", "n", "gaps", "checks")

    def _noted(self) -> None:
        self.version += 1
        rows = [(self.buckets, self.window, level, name, files, self.key) for level, name, files in self.runs] or [(self.buckets, self.window, 0, None, 0, self.key)]
        self.spark.createDataFrame(rows, "buckets int, window int, level int, name string, files int, key binary").coalesce(1).write.parquet(f"{self.path}/manifest-{self.version}")

    def add(self, docs: DataFrame, parts: int) -> DataFrame | None:
        """Match a batch with the index and with itself, and keep its windows. Rows (part, fps, checks, ids) of the windows that
        occur in an earlier batch or in a document of this batch with a smaller id."""
        new = docs.select("doc_id", "text").where("doc_id IS NOT NULL").mapInArrow(_fingerprints(self.window, self.buckets, parts, self.key), "bucket int, fps binary, checks binary, ids binary")
        known = self.spark.createDataFrame([], RUN)
        for i, run in enumerate(self.runs):
            known = known.unionByName(self._read(run)) if i else self._read(run)
        both = new.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(_merge(parts), f"{RUN}, part int, fps binary, ids binary, kind int")
        path = self._write(both, 0)
        gone = self.compact()
        self._noted()
        for run in gone:  # once no manifest names them
            self.spark.sql(f"DROP TABLE IF EXISTS {run[1]}")
            drop(self.spark, f"{self.path}/{run[1]}/kind={WINDOWS}")
        return self.spark.read.schema(_HITS).parquet(f"{path}/kind={HITS}") if exists(self.spark, f"{path}/kind={HITS}") else None

    def compact(self) -> list[tuple]:
        """Merge the runs of a level as long as one has FANOUT of them; the runs that are no longer needed."""
        gone = []
        while full := next((same for level in {r[0] for r in self.runs} if len(same := [r for r in self.runs if r[0] == level]) >= FANOUT), None):
            rows = self._read(full[0])
            for r in full[1:]:
                rows = rows.groupBy("bucket").cogroup(self._read(r).groupBy("bucket")).applyInArrow(_compacted, RUN)
            self._write(rows.withColumn("kind", F.lit(WINDOWS)), full[0][0] + 1)
            self.runs = [r for r in self.runs if r not in full]
            gone += full
        return gone

    def close(self) -> None:
        """Take the runs' tables out of the session's catalogue; the index stays in its folder."""
        for r in self.runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {r[1]}")


def _ranges(docs: DataFrame, batches: int) -> list[DataFrame]:
    """docs in ascending ranges of doc_id."""
    at = docs.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 10000).alias("at")).first()["at"] if batches > 1 else None
    edges, out = [None, *sorted(set(at or [])), None], []
    for low, high in zip(edges, edges[1:], strict=False):
        batch = docs if low is None else docs.where(F.col("doc_id") > low)
        out.append(batch if high is None else batch.where(F.col("doc_id") <= high))
    return out


def duplicate_windows(docs: DataFrame, window: int = WINDOW, batches: int = BATCHES, index: WindowIndex | None = None, key: bytes | None = None) -> DataFrame:
    """(id, hits, hit_checks): each document that has windows which also start in a document with a smaller id or are in the index,
    and their fingerprints.

    Documents enter the index in ascending ranges of doc_id; without an index they enter a new one that goes afterwards. Rows
    without an id take no part; a repeated id is one document.
    """
    spark = docs.sparkSession
    small_batches(spark)
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    parts = parts_for(spark, size, 16 << 20)
    own = index or WindowIndex(spark, work_path(spark, "window_index"), parts_for(spark, size, 8 << 20), window, key)
    try:
        found = [hits for batch in _ranges(docs, batches) if (hits := own.add(batch, parts)) is not None]
        out = spark.createDataFrame([], _HITS) if not found else found[0]
        for hits in found[1:]:
            out = out.unionByName(hits)
        return saved(out.groupBy("part").applyInArrow(by_document, "id long, hits binary, hit_checks binary"), "window_hits")
    finally:
        if index is None:
            own.close()
            drop(spark, own.path)


def _kept(window: int, key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_slices(batch):
                w = words(batch.column("text").slice(a, b - a))
                hits, hit_checks = (batch.column(c).slice(a, b - a).to_pylist() for c in ("hits", "hit_checks"))
                fps, checks, text, at = _window_hashes(w, window, key) if any(hits) else [np.zeros(0, np.int64)] * 4
                edge = np.searchsorted(text, np.arange(len(hits) + 1))
                cover = np.zeros(len(w.start) + 1, np.int32)
                for i, h in enumerate(hits):
                    if h:
                        mine = slice(edge[i], edge[i + 1])
                        s = at[mine][_held(fps[mine], checks[mine], np.frombuffer(h, "<u8"), np.frombuffer(hit_checks[i], "<u4"))]
                        np.add.at(cover, s, 1)
                        np.add.at(cover, s + window, -1)
                gone = np.cumsum(cover)[:-1] > 0
                texts, removed = [], []
                for i in range(len(hits)):
                    x, y = w.first[i], w.first[i + 1]
                    stay = np.flatnonzero(~gone[x:y]) + x
                    raw = w.data[w.start[x] : w.end[y - 1]].tobytes() if y > x else b""
                    low = w.start[x] if y > x else 0
                    texts.append(b" ".join([raw[s:e] for s, e in zip((w.start[stay] - low).tolist(), (w.end[stay] - low).tolist(), strict=True)]).decode())
                    removed.append(int(y - x - len(stay)))
                keep = [c for c in batch.schema.names if c not in ("hits", "hit_checks")]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(w.counts()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())], [*keep, "n_words", "n_removed", "kept_text"])

    return run


def dedup_substrings(docs: DataFrame, window: int = WINDOW, batches: int = BATCHES, index: WindowIndex | None = None) -> DataFrame:
    """Remove each word covered by a window of `window` words that also starts in a document with a smaller doc_id.

    Returns doc_id, n_words, n_removed and kept_text (kept words joined by a space), one row for each input row. A null or
    empty text has no words. A row without doc_id keeps all its words and covers none of others; rows with one doc_id are one
    document; other columns, whatever their names, are left out. With an index, windows of its earlier batches are removed too,
    and these documents' windows stay in it.
    """
    key = index.key if index else new_key()
    hits = duplicate_windows(docs, window, batches, index, key)
    rows = docs.select("doc_id", "text").join(hits, F.col("doc_id") == F.col("id"), "left").select("doc_id", "text", "hits", "hit_checks")
    out = rows.mapInArrow(_kept(window, key), "doc_id long, text string, n_words long, n_removed long, kept_text string")
    return out.drop("text")


def sha256_of(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sha256_of(dedup_substrings(table(spark, sf_dir, "documents")))


ORACLE = {
    "op2_substring_dedup": """
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), p AS (
  SELECT doc_id, i, sha256(array_to_string(words[i:i + 12], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13)
), f AS (
  SELECT h, min(doc_id) AS owner FROM p GROUP BY h
), r AS (
  SELECT DISTINCT doc_id, j FROM (
    SELECT p.doc_id, unnest(range(i, i + 13)) AS j FROM p JOIN f USING (h) WHERE p.doc_id > f.owner)
), k AS (
  SELECT doc_id, i, words[i] AS word FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM w)
)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, CAST(len(w.words) - coalesce(max(c.n), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(max(c.kept), '')) AS kept_sha256
FROM w LEFT JOIN (
  SELECT k.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS kept
  FROM k ANTI JOIN r ON k.doc_id = r.doc_id AND k.i = r.j GROUP BY k.doc_id) c ON c.doc_id = w.doc_id
GROUP BY w.doc_id, w.words
"""
}
