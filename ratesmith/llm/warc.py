"""WARC archives: a writer with revisit records, and a reader that proves record boundaries by their chain.

The reader splits archives at the magic line wherever it stands, also inside payloads and between the splits of one file. Each
such place is a candidate with a successor, the byte at which its record ends by its own length. Pointer jumping from byte 0
keeps the candidates that the chain of true records reaches.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import freed_shuffles, saved, spread_join, table, work_path

MAGIC = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
#: Payloads of fewer bytes are never revisits.
REVISIT_BYTES = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FIELD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)")


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def revisits(pages: DataFrame, least: int) -> DataFrame:
    """(page_id, payload_sha256, refers_to) of the pages whose payload of at least `least` bytes a larger page_id has too."""
    each = saved(pages.where(F.octet_length("payload") >= least).select("page_id", F.sha2("payload", 256).alias("payload_sha256")), "warc_payloads")
    owners = each.groupBy("payload_sha256").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n_rows"))
    return spread_join(each, owners, "payload_sha256", each.count()).where("page_id < refers_to").distinct()


def write_warc(pages: DataFrame, path: str, least: int = REVISIT_BYTES, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write one record for each row of pages (page_id, url, html) into the files of `path`, uncompressed.

    Of rows with equal payloads of at least `least` bytes, that with the largest page_id is a response and the others are
    revisits of it (all rows that have the largest page_id are responses). Null or empty html is an empty payload. A row without
    page_id is a response of its own; line breaks in a url are percent-encoded; other columns are left out.
    """
    body = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    known = saved(revisits(body, least), "warc_revisits")
    rows = body.withColumn("sha", F.when(F.octet_length("payload") >= least, F.sha2("payload", 256)))
    rows = rows.join(known.withColumnRenamed("page_id", "of"), (F.col("page_id") == F.col("of")) & (F.col("sha") == F.col("payload_sha256")), "left")
    again = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), _line("Content-Length", F.octet_length("payload").cast("string")), F.lit("\r\n"))
    page = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    block = F.octet_length(http) + F.when(again, 0).otherwise(F.octet_length("payload"))
    head = F.concat(
        F.lit(MAGIC.decode()), _line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))), _line("WARC-Record-ID", page("page_id")), _line("WARC-Date", F.lit(date)),
        F.when(F.col("url").isNull(), F.lit("")).otherwise(_line("WARC-Target-URI", F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1("payload"))), F.when(again, F.concat(_line("WARC-Profile", F.lit(PROFILE)), _line("WARC-Refers-To", page("refers_to")))).otherwise(F.lit("")),
        _line("Content-Type", F.lit("application/http;msgtype=response")), _line("Content-Length", block.cast("string")), F.lit("\r\n"), http,
    )
    record = F.concat(head.cast("binary"), F.when(again, F.lit(b"")).otherwise(F.col("payload"))).cast("string")
    with freed_shuffles(pages.sparkSession):
        rows.select(record.alias("value")).write.option("lineSep", END.decode()).text(path)


def _fields(head: bytes) -> dict[str, str]:
    return {k.decode("latin-1").strip().lower(): v.decode("utf-8", "replace").strip() for k, v in _FIELD.findall(head)}


def _record(segment: bytes) -> tuple | None:
    """What the bytes after a magic line say, if they are a record's head: its length, fields, and the block that follows."""
    stop = segment.find(END)
    fields = _fields(segment[:stop]) if stop >= 0 else {}
    if not fields.get("content-length", "").isdigit() or "warc-type" not in fields:
        return None
    size = int(fields["content-length"])
    return stop + 4 + size, fields, segment[stop + 4 : stop + 4 + size]


def _payload(fields: dict[str, str], block: bytes) -> tuple:
    """page_id, url, record_type, refers_to, payload_bytes and payload_digest of a whole record."""
    head, _, body = block.partition(END) if fields.get("content-type", "").startswith("application/http") else (b"", b"", block)
    page = lambda x: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(x, ""))) else None
    size, digest = len(body), hashlib.sha1(body).hexdigest()
    if fields["warc-type"] == "revisit":
        size, digest = int(_fields(head).get("content-length", 0)), fields.get("warc-payload-digest", "").removeprefix("sha1:")
    return page("warc-record-id"), fields.get("warc-target-uri"), fields["warc-type"], page("warc-refers-to"), size, digest


_OUT = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"
_AT = "path string, block long, at long, size long, length long"


def _segments(whole: bool):
    """The pieces between magic lines, with their places counted from where their split's first piece begins. whole: their bytes
    as well; else what they hold as a record. length: -1 if no record begins here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, int] = {}
        for batch in batches:
            out = []
            for path, block, raw in zip(batch.column("path").to_pylist(), batch.column("block").to_pylist(), batch.column("value"), strict=True):
                data = raw.as_py()
                # the first piece of a file stands before its first magic line
                first = block == 0 and (path, block) not in held
                at, size = held.get((path, block), 0), len(data) + len(MAGIC) * (not first)
                held = {(path, block): at + size}
                if not size:
                    continue
                if whole:
                    out.append((path, block, at, size, data if first else MAGIC + data))
                    continue
                got = None if first else _record(data)
                full = got is not None and got[0] <= len(data)
                out.append((path, block, at, size, got[0] + len(MAGIC) + len(END) if got else -1, *(_payload(*got[1:]) if full else [None] * 6)))
            if out:
                kinds = [pa.string(), *[pa.int64()] * 3, *([pa.binary()] if whole else [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()])]
                names = ["path", "block", "at", "size", *(["data"] if whole else ["length", "page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"])]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return run


def _scan(spark: SparkSession, paths: list[str], whole: bool) -> DataFrame:
    rows = spark.read.option("lineSep", MAGIC.decode()).text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))
    return rows.mapInArrow(_segments(whole), "path string, block long, at long, size long, data binary" if whole else f"{_AT}, {_OUT}")


def _chain(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """Of one file's candidates: the places of the true records, and the pieces of those whose payload holds magic lines."""
    order = np.argsort(t.column("at").to_numpy(), kind="stable")
    at, size, length = (t.column(c).to_numpy()[order] for c in ("at", "size", "length"))
    n, end = len(at), int((at + size).max())
    after = np.where(length >= 0, at + length, -1)
    to = np.searchsorted(at, after)
    ends = (after == end) | (to == n) & (after >= end - len(END))  # a last record may lack its empty lines
    jump = np.where((length >= 0) & (to < n) & (at[np.minimum(to, n - 1)] == after), to, n)
    jump = np.r_[np.where(ends, n, jump), n]
    reached = np.zeros(n + 1, bool)
    reached[np.flatnonzero((at == 0) & (length >= 0))] = True
    whole = (jump[:-1] < n) | ends
    hop = jump
    for _ in range(max(1, n.bit_length())):
        reached[hop[reached]] = True
        hop = hop[hop]
    true = np.flatnonzero(reached[:-1] & whole)
    pieces = np.where(jump[true] < n, jump[true], n) - true
    many = true[pieces > 1]
    inner = np.concatenate([np.arange(i, i + k) for i, k in zip(many, pieces[pieces > 1], strict=True)]) if len(many) else np.zeros(0, np.int64)
    own = np.repeat(many, pieces[pieces > 1])
    single = true[pieces == 1]
    where, record = np.concatenate([single, inner]), np.concatenate([single, own])
    return pa.table({"path": pa.array([key[0].as_py()] * len(where), pa.string()), "place": at[where], "record": at[record], "parts": np.concatenate([np.ones(len(single), np.int64), np.full(len(inner), 2)])})


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for pieces in batch.column("pieces").to_pylist():
            _, fields, block = _record(b"".join(p["data"] for p in pieces)[len(MAGIC) :])
            out.append(_payload(fields, block))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"])


def _placed(rows: DataFrame) -> DataFrame:
    """Places counted from the file's start: a split's pieces begin where those of the split before end."""
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = rows.groupBy("path", "block").agg(F.sum("size").alias("bytes")).select("path", "block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    return rows.join(base, ["path", "block"]).withColumn("at", F.col("at") + F.col("base")).drop("base", "block")


def read_warc(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_bytes and payload_digest (SHA-1, hex) of each record that the chain from a
    file's start reaches. A revisit's last two are its original's, as its own head has them. What stands behind a broken or
    cut-off record of a file can't be proved to be a record and is left out; an empty file has no records."""
    found = saved(_placed(_scan(spark, [path] if isinstance(path, str) else path, whole=False)), "warc_candidates")
    # a file's candidates are some 24 bytes each, whatever its records hold
    chain = saved(found.select("path", "at", "size", "length").groupBy("path").applyInArrow(_chain, "path string, place long, record long, parts long"), "warc_chain")
    out = found.join(chain.where("parts = 1").select("path", F.col("place").alias("at")).hint("merge"), ["path", "at"]).select("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest")
    split = chain.where("parts > 1")
    files = [r["path"] for r in split.select("path").distinct().toLocalIterator()]
    if not files:
        return out
    pieces = _placed(_scan(spark, files, whole=True)).join(split.select("path", F.col("place").alias("at"), "record"), ["path", "at"])
    whole = pieces.groupBy("path", "record").agg(F.array_sort(F.collect_list(F.struct("at", "data"))).alias("pieces")).select("pieces")
    return out.unionByName(whole.mapInArrow(_joined, _OUT))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = {
    "op7_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, coalesce(html, '') AS html FROM pages
), o AS (SELECT html, max(page_id) AS owner FROM p WHERE n >= 1000 GROUP BY html)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN p.page_id < o.owner THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN p.page_id < o.owner THEN o.owner END AS refers_to
FROM p LEFT JOIN o ON o.html = p.html
"""
}
