"""N-gram Jaccard join of whole texts, by a token-group matrix.

Equal shingle sets are one set. A set can only have partners if it shares enough of its shingles with any other set, so the
document frequency of every shingle comes first, and sets of mostly unique shingles leave. For that, texts are packed into slices;
a slice sends each of its shingles once, with its frequency there, to the shingle's bucket, and gets a byte for each one back:
nothing that is sent names a document, and a shingle that all documents hold comes once from each slice. Sets that stay are put
into groups of similar sets. Each group's links are found inside it; then only sets of different components are left to be
compared: a set asks the groups with which it shares a shingle of both prefixes, each group keeps the union of its shingles, the
union bounds the overlap with the asking set, and only groups that reach the threshold are opened and compared member by member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget, parts_for, saved, small_batches, spread_join, table, text_bytes
from .components import components
from .shingles import SPACES, give_back, mix, new_key, text_slices, windows, words

WORDS, PERCENT = 4, 85
GROUP = 256
#: Sets that speak for a component when components of one kind are compared.
DELEGATES = 4
#: Sets that ask one group in one task.
ASKING = 256
#: Bytes of text in one slice, and bytes of text whose shingles are counted in one bucket.
SLICE, BUCKET = 2 << 20, 8 << 20
#: Bits of a shingle's hash, over those that number all bytes of text, by which its frequency is known: of 256 shingles one may
#: seem to be shared when it isn't, which costs a comparison and no result.
SPARE_BITS = 6


def _sets(batch: pa.RecordBatch, k: int, key: bytes) -> tuple[np.ndarray, ...]:
    """Shingles, sorted within each text and without repeats, with their texts; each text's set size and id, a hash of the set."""
    w = words(batch.column("text"), SPACES, lower=True)
    fps, text, _ = windows(w.keyed_hashes(key), w.first, k, short=True, key=key)
    order = np.lexsort((fps, text))
    fps, text = fps[order], text[order]
    new = np.r_[True, (fps[1:] != fps[:-1]) | (text[1:] != text[:-1])] if len(fps) else np.zeros(0, bool)
    fps, text = fps[new], text[new]
    edge = np.searchsorted(text, np.arange(batch.num_rows + 1))
    total = np.r_[np.uint64(0), np.cumsum(mix(fps ^ np.uint64(0x5DEECE66D)))]
    size = np.diff(edge)
    return fps, text, size, mix(total[edge[1:]] - total[edge[:-1]] + mix(size.astype(np.uint64))).view(np.int64)


def _set_rows(k: int, key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_slices(batch):
                part = batch.slice(a, b - a)
                _, _, size, ids = _sets(part, k, key)
                own = [c for c in part.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in own), pa.array(size), pa.array(ids, mask=size == 0)], [*own, "n_shingles", "set"])

    return run


_SLICE_ROW = "slice long, sizes binary, data binary, n_bytes long"


def _pack(texts: list[pa.Array], number: int) -> pa.RecordBatch:
    """One row of the distinct texts of a slice, compressed."""
    distinct = pc.unique(pa.chunked_array(texts, pa.string()))
    sizes = pc.binary_length(distinct).to_numpy().astype("<i4")
    data = pa.py_buffer("".join(distinct.to_pylist()).encode())
    task = TaskContext.get()
    uid = (task.partitionId() if task else 0) << 32 | number
    return pa.RecordBatch.from_arrays([pa.array([uid]), pa.array([sizes.tobytes()], pa.binary()), pa.array([pa.compress(data, "zstd", asbytes=True)], pa.binary()), pa.array([data.size])], _SLICE_ROW.replace(",", "").split()[::2])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size, number = [], 0, 0
    for batch in batches:
        for a, b in text_slices(batch):
            texts = batch.column("text").slice(a, b - a)
            texts = texts.filter(pc.greater(pc.fill_null(pc.binary_length(texts), 0), 0)).cast(pa.string())
            held.append(texts)
            size += pc.sum(pc.binary_length(texts)).as_py() or 0
            if size >= SLICE:
                yield _pack(held, number)
                held, size, number = [], 0, number + 1
    if size:
        yield _pack(held, number)


def _unpack(row: dict) -> pa.RecordBatch:
    """The texts of a slice."""
    sizes = np.frombuffer(row["sizes"], "<i4")
    data = pa.decompress(row["data"], row["n_bytes"], "zstd")
    texts = pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(np.r_[0, np.cumsum(sizes, dtype=np.int64)]), data])
    return pa.RecordBatch.from_arrays([texts], ["text"])


class _Slice:
    """Sets of a slice, once each, and its shingles' keys: the upper bits of their hashes, sorted, with their frequencies here."""

    def __init__(self, row: dict, k: int, key: bytes, bits: int, buckets: int):
        fps, text, size, ids = _sets(_unpack(row), k, key)
        kept = np.unique(ids, return_index=True)[1]
        kept = kept[size[kept] > 0]
        once = np.zeros(len(ids), bool)
        once[kept] = True
        self.fps, self.text, self.sets, self.size = fps[once[text]], text[once[text]], ids, size
        self.keys, self.key_of, count = np.unique(self.fps >> np.uint64(64 - bits), return_inverse=True, return_counts=True)
        self.count = np.minimum(count, 255).astype(np.uint8)
        self.cuts = self._cuts((self.keys << np.uint64(64 - bits) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32))
        self.own = np.sort(ids[kept])
        self.own_cuts = self._cuts(((self.own.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32))

    @staticmethod
    def _cuts(bucket: np.ndarray) -> list[tuple[int, int, int]]:
        """(bucket, from, to) of sorted buckets."""
        at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
        return list(zip(bucket[at].tolist(), at.tolist(), [*at[1:].tolist(), len(bucket)], strict=True))


def _packed_gaps(keys: np.ndarray) -> bytes:
    """Gaps between sorted integers, their bytes by place, as many as the widest needs."""
    gaps = np.diff(keys)
    width = max(1, -(-int(gaps.max()).bit_length() // 8)) if len(gaps) else 1
    return np.ascontiguousarray(gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unpacked_gaps(first: int, n: int, raw: bytes) -> np.ndarray:
    gaps = np.zeros((n, 8), np.uint8)
    gaps[0] = np.frombuffer(np.uint64(first).tobytes(), np.uint8)
    if n > 1:
        width = len(raw) // (n - 1)
        gaps[1:, :width] = np.frombuffer(raw, np.uint8).reshape(width, n - 1).T
    return np.cumsum(gaps.view("<u8").ravel(), dtype=np.uint64)


_SENT = "bucket int, slice long, n int, first long, gaps binary, counts binary"


def _shingles(k: int, key: bytes, bits: int, buckets: int):
    """Keys and frequencies by bucket, in buckets 0 and up; ids of sets in buckets -1 and down."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                s = _Slice(row, k, key, bits, buckets)
                keys = [(b, j - i, int(s.keys[i : i + 1].view(np.int64)[0]), _packed_gaps(s.keys[i:j]), s.count[i:j].tobytes()) for b, i, j in s.cuts]
                sets = [(-1 - b, j - i, 0, s.own[i:j].astype("<i8").tobytes(), None) for b, i, j in s.own_cuts]
                if keys:
                    cols = list(zip(*keys, *sets, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array([row["slice"]] * len(cols[0])), *(pa.array(x, t) for x, t in zip(cols[1:], (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True))], _SENT.replace(",", "").split()[::2])

    return run


_REPLY = "slice long, bucket int, reply binary"


def _replies(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """To each slice a byte for each key that it sent: 0 if no other set holds it, else a class of its frequency in all slices. For
    ids of sets: 1 if the slice is the least that has the set."""
    give_back()
    t = t.sort_by("slice")
    n, slices = t.column("n").to_numpy(), t.column("slice").to_numpy()
    cuts = np.r_[0, np.cumsum(n)]
    if key[0].as_py() < 0:
        sets = np.concatenate([np.frombuffer(x.as_buffer(), "<i8") for x in t.column("gaps")])
        flat = np.zeros(len(sets), np.uint8)
        flat[np.unique(sets, return_index=True)[1]] = 1
    else:
        keys = np.empty(cuts[-1], np.uint64)
        counts = np.empty(cuts[-1], np.uint8)
        for i, (m, first, raw, count) in enumerate(zip(n.tolist(), t.column("first").to_pylist(), t.column("gaps"), t.column("counts"), strict=True)):
            keys[cuts[i] : cuts[i + 1]] = _unpacked_gaps(int(np.int64(first).view(np.uint64)), m, raw.as_buffer())
            counts[cuts[i] : cuts[i + 1]] = np.frombuffer(count.as_buffer(), np.uint8)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        total = np.add.reduceat(counts[order].astype(np.int64), first)
        kind = np.where(total > 1, np.minimum(1 + np.floor(4 * np.log2(total)), 255), 0).astype(np.uint8)
        flat = np.empty(cuts[-1], np.uint8)
        flat[order] = np.repeat(kind, np.diff(np.r_[first, len(keys)]))
    return pa.table({"slice": pa.array(slices), "bucket": pa.array([key[0].as_py()] * len(n), pa.int32()), "reply": pa.array([flat[i:j].tobytes() for i, j in zip(cuts, cuts[1:], strict=False)], pa.binary())})


def _candidates(k: int, key: bytes, bits: int, buckets: int, percent: int):
    """Sets that share enough shingles for a link: all shared shingles, rare ones first, and how many of them are the prefix."""

    def run(_: tuple[pa.Scalar, ...], slices: pa.Table, replies: pa.Table) -> pa.Table:
        out = pa.table({"set": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "prefix": pa.array([], pa.int64()), "low": pa.array([], pa.int64()), "tokens": pa.array([], pa.binary())})
        if not slices.num_rows or not replies.num_rows:
            return out
        give_back()
        s = _Slice(slices.to_pylist()[0], k, key, bits, buckets)
        got = dict(zip(replies.column("bucket").to_pylist(), replies.column("reply"), strict=True))
        join = lambda cuts, sign: np.concatenate([np.frombuffer(got[b if sign else -1 - b].as_buffer(), np.uint8) for b, _, _ in cuts])
        kind = join(s.cuts, True)[s.key_of]
        mine = s.own[join(s.own_cuts, False) > 0]
        keep = (kind > 0) & np.isin(s.sets, mine)[s.text]
        f, kind, text = s.fps[keep], kind[keep], s.text[keep]
        if not len(f):
            return out
        order = np.lexsort((f, kind, text))
        f, text = f[order], text[order]
        cuts = np.r_[np.flatnonzero(np.r_[True, text[1:] != text[:-1]]), len(f)]
        at = text[cuts[:-1]]
        n, shared = s.size[at], np.diff(cuts)
        need = -(-percent * n // 100)
        low = np.minimum.reduceat(mix(f), cuts[:-1]).view(np.int64)
        stay = np.flatnonzero(shared >= need)
        return pa.table({
            "set": pa.array(s.sets[at][stay]), "n": pa.array(n[stay].astype(np.int64)), "prefix": pa.array((shared - need + 1)[stay].astype(np.int64)), "low": pa.array(low[stay]),
            "tokens": pa.array([f[cuts[i] : cuts[i + 1]].tobytes() for i in stay], pa.binary()),
        })

    return run


_CANDIDATE = "set long, n long, prefix long, low long, tokens binary"


class _Matrix:
    """Columns for the tokens of some sets, and their rows in slices of columns."""

    def __init__(self, tokens: list[np.ndarray]):
        self.union, self.column = np.unique(np.concatenate([*tokens, np.zeros(0, np.uint64)]), return_inverse=True)
        self.row = np.repeat(np.arange(len(tokens)), [len(x) for x in tokens])
        self.rows = len(tokens)

    @staticmethod
    def _dense(row: np.ndarray, column: np.ndarray, rows: int, low: int, width: int) -> np.ndarray:
        out = np.zeros((rows, width), np.float32)
        out[row, column - low] = 1
        return out

    def overlaps(self, other: list[np.ndarray] | None = None, step: int = 8192) -> np.ndarray:
        """Sizes of the intersections of other sets, or of these, with these."""
        if other is None:
            row, column, rows = self.row, self.column, self.rows
        else:
            flat, rows = np.concatenate([*other, np.zeros(0, np.uint64)]), len(other)
            at = np.searchsorted(self.union, flat)
            inside = (at < len(self.union)) & (self.union[np.minimum(at, len(self.union) - 1)] == flat) if len(self.union) else np.zeros(len(flat), bool)
            row, column = np.repeat(np.arange(rows), [len(x) for x in other])[inside], at[inside]
        out = np.zeros((rows, self.rows), np.float32)
        mine, theirs = np.argsort(self.column, kind="stable"), np.argsort(column, kind="stable")
        for low in range(0, len(self.union), step):
            width = min(step, len(self.union) - low)
            i, j = (x[slice(*np.searchsorted(c[x], (low, low + width)))] for x, c in ((mine, self.column), (theirs, column)))
            a = self._dense(self.row[i], self.column[i], self.rows, low, width)
            out += (a if other is None else self._dense(row[j], column[j], rows, low, width)) @ a.T
        return np.rint(out).astype(np.int64)

    def bound(self, other: list[np.ndarray]) -> np.ndarray:
        """How many tokens of each other set are in the union."""
        flat = np.concatenate([*other, np.zeros(0, np.uint64)])
        return np.bincount(np.repeat(np.arange(len(other)), [len(x) for x in other]), weights=np.isin(flat, self.union), minlength=len(other)).astype(np.int64)


def _linked(both: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    return 100 * both >= percent * (n[:, None] + m[None, :] - both)


def _tokens(t: pa.Table, column: str = "tokens") -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), "<u8") for x in t.column(column)]


def _roots(links: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The least start value in each node's component."""
    label = start.copy()
    while True:
        low = np.where(links, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        low = np.minimum(label, low)
        if (low == label).all():
            return label
        label = low


def _inside(percent: int):
    """Components inside one group; root: the least label there. Sets that have one label are linked beforehand."""

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        n, label = t.column("n").to_numpy(), t.column("label").to_numpy()
        links = _linked(_Matrix(_tokens(t)).overlaps(), n, n, percent) | (label[:, None] == label[None, :])
        return pa.table({"set": t.column("set"), "was": t.column("label"), "label": pa.array(_roots(links, label))})

    return run


def _opened(percent: int):
    """Links between the sets that ask a group and its members of other components, once for each pair of components."""

    def run(key: tuple[pa.Scalar, ...], members: pa.Table, asking: pa.Table) -> pa.Table:
        out = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        if not members.num_rows or not asking.num_rows:
            return out
        matrix, theirs, n = _Matrix(_tokens(members)), _tokens(asking), asking.column("n").to_numpy()
        open_ = np.flatnonzero(matrix.bound(theirs) >= -(-percent * n // 100))
        if not len(open_):
            return out
        links = _linked(matrix.overlaps([theirs[i] for i in open_]), n[open_], members.column("n").to_numpy(), percent)
        a, b = asking.column("label").to_numpy()[open_], members.column("label").to_numpy()
        i, j = np.nonzero(links & (a[:, None] != b[None, :]))
        pairs = np.unique(np.stack([a[i], b[j]], 1), axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def _grouped(rows: DataFrame, key: str, of: str, name: str) -> DataFrame:
    """Split what has one key into groups of about GROUP, by a hash of `of`."""
    large = saved(rows.groupBy(key).count().where(F.col("count") > GROUP).select(key, F.ceil(F.col("count") / GROUP).alias("subs")), name)
    return rows.join(large, key, "left").withColumn("sub", F.pmod(F.xxhash64(of), F.coalesce("subs", F.lit(1)))).drop("subs")


def _set_labels(candidates: DataFrame, percent: int) -> DataFrame:
    """(set, label) of the candidate sets; equal labels are components."""
    first = _grouped(candidates.withColumn("label", F.col("set")), "low", "set", "jaccard_large")
    inside = saved(first.groupBy("low", "sub").applyInArrow(_inside(percent), "set long, was long, label long").select("set", "label"), "jaccard_inside")
    # components that large groups were split into: some sets of each meet again
    split = candidates.join(inside, "set")
    hot = split.groupBy("low").agg(F.count("*").alias("c")).where(F.col("c") > GROUP).select("low")
    one_of = F.pmod(F.xxhash64("set"), F.lit(DELEGATES)).alias("one_of")  # the least of each share, so that a large component isn't gathered
    some = split.select("low", "label", "set").join(hot, "low", "left_semi").groupBy("low", "label", one_of).agg(F.min("set").alias("set")).select("set")
    speak = saved(split.join(some, "set", "left_semi"), "jaccard_delegates")
    again = _grouped(speak, "low", "label", "jaccard_large")
    moved = again.groupBy("low", "sub").applyInArrow(_inside(percent), "set long, was long, label long").where("was <> label").groupBy("was").agg(F.min("label").alias("to"))
    moved = saved(moved, "jaccard_moved")
    out = saved(inside.join(moved, inside["label"] == moved["was"], "left").select("set", F.coalesce("to", "label").alias("label")), "jaccard_labels")
    forget(inside, speak, moved)
    return out


def _links_between(candidates: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between labels: all that are left."""
    sizes = labels.groupBy("label").agg(F.count("*").alias("size"))
    known = candidates.join(labels, "set").join(sizes, "label")
    # the smaller component asks: large components of near copies are asked, and ask nobody
    rows = known.withColumns({"rank": F.struct("size", "label"), "kin": F.when(F.col("size") > 1, F.col("label")).otherwise(F.col("low")), "alone": F.col("size") == 1})
    rows = saved(_grouped(rows, "kin", "set", "jaccard_large").withColumn("group", F.struct("alone", "kin", "sub")), "jaccard_rows")
    prefix = rows.select("set", "group", "rank", F.explode(_token_column()).alias("token"))
    open_ = prefix.groupBy("token").agg(F.min("rank").alias("low"), F.max("rank").alias("high")).where("low < high").select("token")
    prefix = saved(prefix.join(open_, "token", "left_semi"), "jaccard_prefixes")
    asked = prefix.groupBy("token", "group").agg(F.max("rank").alias("high"))
    pairs = saved(prefix.select("token", "set", "rank").join(asked, "token").where("rank < high").select("set", "group").distinct(), "jaccard_pairs")
    forget(prefix)
    salts = pairs.groupBy("group").agg(F.ceil(F.count("*") / ASKING).alias("salts"))
    members = rows.join(salts, "group").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    asking = rows.select("set", "n", "label", "tokens").join(pairs, "set").join(salts, "group").withColumn("salt", F.pmod(F.xxhash64("set"), F.col("salts")))
    side = lambda df: df.select("group", "salt", "n", "label", "tokens").toDF("group", "salt", "n", "label", "tokens").groupBy("group", "salt")
    links = saved(side(members).cogroup(side(asking)).applyInArrow(_opened(percent), "a long, b long").distinct(), "jaccard_links")
    forget(rows, pairs)
    return links


def _token_column():
    """The prefix of tokens, as longs."""
    at = F.sequence(F.lit(0).cast("long"), F.col("prefix") - 1)
    return F.transform(at, lambda i: F.conv(F.hex(F.reverse(F.substring("tokens", (i * 8 + 1).cast("int"), F.lit(8)))), 16, 10).cast("decimal(20,0)"))


def linked_components(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Components of documents whose sets of k-word shingles have a Jaccard similarity of at least percent / 100.

    Words are runs without ASCII white space, A-Z as a-z. A text of fewer words is one shingle; a text without words, empty or
    null, has no shingles and no links. Returns doc_id, n_shingles and component_id, the least doc_id of the component, one row
    for each input row. Rows without doc_id link nothing and have no component; of rows with one doc_id each counts by its own
    text. Other columns are left out. Shingles and sets are known by 64-bit hashes under a key that each call draws anew.
    """
    rows = saved(linked_sets(docs.select("doc_id", "text"), k, percent), "jaccard_rows")
    least = rows.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_rows"))
    return spread_join(rows, least, "component", rows.count()).select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def linked_sets(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The columns of docs but text, n_shingles and component, by the rules of linked_components; one row for each input row.

    component is an id of its own, null where there is no doc_id or no shingle. Rows with one doc_id and different texts can have
    different components.
    """
    spark = docs.sparkSession
    small_batches(spark)
    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"]
    size, key = text_bytes(docs), new_key()
    buckets, bits = parts_for(spark, size, BUCKET), min(64, max(32, size.bit_length() + SPARE_BITS))
    each = saved(docs.mapInArrow(_set_rows(k, key), ", ".join([*own, "n_shingles long, set long"])), "jaccard_sets")
    slices = saved(docs.where("doc_id IS NOT NULL").select("text").mapInArrow(_slices, _SLICE_ROW), "jaccard_slices", "none")
    sent = slices.mapInArrow(_shingles(k, key, bits, buckets), _SENT)
    replies = saved(sent.groupBy("bucket").applyInArrow(_replies, _REPLY), "jaccard_replies")
    both = slices.groupBy("slice").cogroup(replies.groupBy("slice"))
    candidates = saved(both.applyInArrow(_candidates(k, key, bits, buckets, percent), _CANDIDATE), "jaccard_candidates")
    forget(slices, replies)
    labels = _set_labels(candidates, percent)
    links = _links_between(candidates, labels, percent)
    whole = components(links, "jaccard_components")
    final = labels.join(whole, labels["label"] == whole["node"], "left").select("set", F.coalesce(whole["label"], labels["label"]).alias("component"))
    copies = each.where("set IS NOT NULL").groupBy("set").agg(F.count("*").alias("n_rows"))
    final = saved(final.join(copies, "set"), "jaccard_final")
    forget(candidates, labels, links)
    out = spread_join(each, final, "set", each.count())
    return out.select(*(c for c in each.columns if c != "set"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "set")).alias("component"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_components(table(spark, sf_dir, "documents"))
