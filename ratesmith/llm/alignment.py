"""Alignment of two tokenizers over whole texts: groups of tokens that end at one byte, and the links between tokens that overlap.

Texts of an Arrow batch are encoded by both tokenizers and laid one after the other, so that a token's end is a byte offset in the
whole batch. Ends of either side are counted by offset once (bincount); where both have one, a group ends, and each offset with an
end of either ends one link. Prefix sums over the offsets, read at the documents' ends, give each document's share. Ids are kept in
a working table; links are counted over the corpus as pairs of ids, summed in a task before they are shuffled, and each slice of
documents gets the counts of its own distinct pairs back. A slice holds its distinct stretches of text once, with their ids.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget, parts_for, saved, small_batches, table, text_bytes
from .shingles import Words, by_bucket, distinct, give_back, text_slices
from .token_output import PieceCache, _ragged

#: Bytes of text in one slice, and bytes of text whose slices' pairs meet in one bucket.
SLICE, BUCKET = 2 << 20, 32 << 20
#: Distinct pairs that a task sums before it hands them on.
HELD_PAIRS = 1 << 21

_PRINTED = np.zeros(256, bool)
_PRINTED[0x21:0x7F] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
#: Second bytes of the two signs among the letters from U+00C0 to U+00FF, whose first is 0xC3.
_SIGN = np.zeros(256, bool)
_SIGN[[0x97, 0xB7]] = True
_SLICE_ROW = "slice long, doc_ids binary, nulls binary, n binary, which binary, n_a binary, n_b binary, a binary, b binary"


def packed(x: np.ndarray) -> bytes:
    """Integers by place of their bytes, compressed, so that they are small in working tables and in shuffles."""
    if not len(x):
        return bytes(8)
    raw = np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T).tobytes()
    return len(x).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpacked(raw: bytes | pa.Buffer, kind: str) -> np.ndarray:
    data, width = memoryview(raw), np.dtype(kind).itemsize
    n = int.from_bytes(data[:8], "little")
    if not n:
        return np.zeros(0, kind)
    return np.ascontiguousarray(np.frombuffer(pa.decompress(pa.py_buffer(data[8:]), n * width, "zstd"), np.uint8).reshape(width, n).T).view(kind).ravel()


class Pair(PieceCache):
    """Two tokenizers of one text: A (byte-level, of space + text) and B (pieces that begin with a space mark, which it adds itself).

    Neither makes a token that goes over a single space between two marks that are no white space, so texts are cut there, and each
    distinct stretch is encoded once; for each the cache has 2 * its A tokens + whether both sides give it back, and both sides'
    ids. a_size and b_size are the tokens' bytes by id.
    """

    def __init__(self, a_path: str, b_path: str):
        super().__init__()
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer, pre_tokenizers

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.plain = Tokenizer(self.a.model)  # for stretches of a space and letters, which A's patterns leave whole
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(" ", "merged_with_next"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = sorted(pre_tokenizers.ByteLevel.alphabet())
        to_byte = {c: ord(c) for c in alphabet if ord(c) < 256}
        to_byte |= dict(zip([c for c in alphabet if c not in to_byte], [x for x in range(256) if x not in to_byte.values()], strict=True))
        vocab = self.a.get_vocab()
        a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            a_bytes[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in side], np.int64) for side in (a_bytes, b_bytes))
        self.sides = [(size, np.cumsum(size) - size, np.frombuffer(b"".join(side), np.uint8)) for size, side in ((self.a_size, a_bytes), (self.b_size, b_bytes))]

    def _gives(self, ids: np.ndarray, sizes: np.ndarray, start: np.ndarray, text: np.ndarray, want: np.ndarray) -> bool:
        """Whether the tokens' bytes are those of want."""
        return int(sizes[ids].sum()) == len(want) and bool((text[_ragged(start[ids], sizes[ids])] == want).all())

    def _apart(self, ids: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> np.ndarray | None:
        """How many of the ids belong to each of the stretches that end there; None if a token goes over an end."""
        to = np.cumsum(sizes[ids])
        at = np.searchsorted(to, ends)
        return np.diff(at + 1, prepend=0) if len(to) and at[-1] < len(to) and (to[at] == ends).all() else None

    def _together(self, w: Words, own: np.ndarray, letters: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Numbers and ids of A and of B of stretches that are encoded as one text; None if that doesn't come apart again."""
        joined = w.data[_ragged(w.start[own], w.end[own] - w.start[own])]
        text, ends, out = joined.tobytes().decode(), np.cumsum(w.end[own] - w.start[own]), []
        a = np.array((self.plain if letters else self.a).encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        for ids, (sizes, start, held) in ((a, self.sides[0]), (np.array(self.b.encode(text[1:]), np.uint32), self.sides[1])):
            n = self._apart(ids, sizes, ends) if self._gives(ids, sizes, start, held, joined) else None
            if n is None:
                return None
            out += [n, ids]
        return tuple(out)

    def _learn(self, w: Words, new: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        regular = w.end[new] - w.start[new] > 1
        first, second, last = w.data[w.start[new]], w.data[np.minimum(w.start[new] + 1, w.end[new] - 1)], w.data[w.end[new] - 1]
        near_last = w.data[np.maximum(w.end[new] - 2, 0)]
        regular &= (first == 0x20) & (_PRINTED[second] | (second == 0xC3)) & (_PRINTED[last] | (near_last == 0xC3))
        latin = (w.data == 0xC3) | np.r_[False, w.data[:-1] == 0xC3]
        count = lambda mask: np.r_[0, np.cumsum(mask, dtype=np.int32)]
        odd, dull = count(w.data == 0xE2), count(~_LETTER[w.data] & ~latin | (w.data == 0xC3) & np.r_[_SIGN[w.data[1:]], False])
        regular &= odd[w.end[new]] == odd[w.start[new]]
        letters = regular & (dull[w.end[new]] - dull[w.start[new]] == 1)
        order, sizes, flat = [], [], []
        rest = [new[~regular]]
        for own, plain in ((new[letters], True), (new[regular & ~letters], False)):
            got = self._together(w, own, plain) if len(own) else None
            if got is None:
                rest.append(own)
                continue
            n_a, a, n_b, b = got
            size, out = 1 + n_a + n_b, np.empty(len(own) + len(a) + len(b), np.uint32)
            start = np.cumsum(size) - size
            out[start], out[_ragged(start + 1, n_a)], out[_ragged(start + 1 + n_a, n_b)] = 2 * n_a + 1, a, b
            order.append(own)
            sizes.append(size)
            flat.append(out)
        rest = np.concatenate(rest)
        if len(rest):
            raw = [w.data[x:y] for x, y in zip(w.start[rest].tolist(), w.end[rest].tolist(), strict=True)]
            texts = [x.tobytes().decode() for x in raw]
            both = zip([e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)], self.b.encode([t[1:] for t in texts], num_threads=1), raw, strict=True)
            for a, b, want in both:
                same = all(self._gives(np.array(ids, np.int64), *of, want) for ids, of in zip((a, b), self.sides, strict=True))
                flat.append(np.array([2 * len(a) + same, *a, *b], np.uint32))
                sizes.append(np.array([len(flat[-1])]))
            order.append(rest)
        return np.concatenate(order), np.concatenate(sizes), np.concatenate(flat)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """How many stretches each text has, which they are, and of each distinct one the numbers of its A and B ids, and these. A text
        that is null or empty, or whose joined tokens of either side aren't space + text, has none."""
        full = pc.greater(pc.fill_null(pc.binary_length(texts), 0), 0).to_numpy(zero_copy_only=False)
        own = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts.filter(pa.array(full)).cast(pa.large_string()), pa.scalar(" ", pa.large_string()))
        data, edge = np.frombuffer(own.buffers()[2] or b"", np.uint8), np.frombuffer(own.buffers()[1], np.int64)[own.offset : own.offset + len(own) + 1]
        n, none = np.zeros(len(texts), np.int64), np.zeros(0, np.int64)
        if not len(own):
            return n, none, none, none, none, none
        space = np.flatnonzero(data[: len(data) - 1] == 0x20)
        space = space[space > 1]
        before, after = data[space - 1], data[space + 1]
        cut = np.zeros(len(data) + 1, bool)
        cut[space[(_PRINTED[before] | (data[space - 2] == 0xC3)) & (_PRINTED[after] | (after == 0xC3))]] = True
        cut[edge] = True
        cuts = np.flatnonzero(cut)
        first = np.searchsorted(cuts[:-1], edge)  # each text's first stretch
        d, which = distinct(Words(data, cuts[:-1], cuts[1:], first))
        slot = self.slots(d, self._learn)
        start, head = self.start[slot].astype(np.int64), self.flat[self.start[slot]].astype(np.int64)
        n_a, n_b = head >> 1, self.size[slot] - 1 - (head >> 1)
        same = np.logical_and.reduceat((head & 1)[which] > 0, first[:-1])
        n[full] = np.where(same, np.diff(first), 0)
        return n, which[np.repeat(same, np.diff(first))], n_a, n_b, self.flat[_ragged(start + 1, n_a)], self.flat[_ragged(start + 1 + n_a, n_b)]


def public_pair() -> Pair:
    import public_tokenizers

    return Pair(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def _pair(make: Callable[[], Pair]) -> Pair:
    made = globals().setdefault("_pairs", {})
    if make not in made:
        made[make] = make()
    return made[make]


def _kind(size: np.ndarray) -> str:
    """Two bytes an id where they do."""
    return "<u2" if len(size) <= 1 << 16 else "<u4"


def _encoded(make: Callable[[], Pair]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, task, number = _pair(make), TaskContext.get(), 0
        for batch in batches:
            for x, y in text_slices(batch, most=SLICE):
                n, which, n_a, n_b, a, b = pair.encode(batch.column("text").slice(x, y - x))
                ids = batch.column("doc_id").slice(x, y - x)
                row = [np.array(pc.fill_null(ids, 0), "<i8"), np.array(ids.is_null(), np.uint8), n.astype("<u4"), which.astype("<u4"), n_a.astype("<u4"), n_b.astype("<u4"), a.astype(_kind(pair.a_size)), b.astype(_kind(pair.b_size))]
                uid = (task.partitionId() if task else 0) << 32 | number
                number += 1
                yield pa.RecordBatch.from_arrays([pa.array([uid]), *(pa.array([packed(v)], pa.binary()) for v in row)], _SLICE_ROW.replace(",", "").split()[::2])

    return run


@functools.lru_cache(4)
def _printed(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The digits of the integers below n, one row each, and how many there are; room for a mark after them."""
    text = np.char.encode(np.arange(n).astype(str))
    rows = text.astype(f"S{text.dtype.itemsize + 1}").view(np.uint8).reshape(n, -1).copy()
    return rows, (rows > 0).sum(1)


class _Slice:
    """The tokens of a slice, and what their ends say."""

    def __init__(self, row: dict, pair: Pair):
        of = lambda name, kind: unpacked(row[name], kind)
        self.ids, self.nulls = of("doc_ids", "<i8"), of("nulls", np.uint8) > 0
        n, which = of("n", "<u4").astype(np.int64), of("which", "<u4")
        sides = []
        for counts, ids in ((of("n_a", "<u4").astype(np.int64), of("a", _kind(pair.a_size))), (of("n_b", "<u4").astype(np.int64), of("b", _kind(pair.b_size)))):
            many = counts[which]
            sides += [ids[_ragged((np.cumsum(counts) - counts)[which], many)].astype(np.int64), np.diff(np.r_[0, np.cumsum(many)][np.r_[0, np.cumsum(n)]])]
        self.a, self.n_a, self.b, self.n_b = sides
        ends = [np.cumsum(size[ids]) for size, ids in ((pair.a_size, self.a), (pair.b_size, self.b))]
        n = int(ends[0][-1]) + 1 if len(self.a) else 1
        a_ends, b_ends = (np.bincount(e, minlength=n) for e in ends)
        self.cut, either = a_ends & b_ends, a_ends | b_ends
        at = np.flatnonzero(either)
        # tokens of each side that have ended before: the place of the one that goes on
        a_to, b_to = (np.cumsum(x) for x in (a_ends, b_ends))
        self.link_a, self.link_b = a_to[at] - a_ends[at], b_to[at] - b_ends[at]
        self.group_ends = a_to[np.flatnonzero(self.cut)], b_to[np.flatnonzero(self.cut)]
        self.pairs = self.a[self.link_a] << 32 | self.b[self.link_b]
        self.edge = np.r_[0, ends[0]][np.r_[0, np.cumsum(self.n_a)]]  # bytes before each document
        self.links_before, self.cuts_before = np.cumsum(either)[self.edge], np.cumsum(self.cut)[self.edge]  # no token ends at 0

    def per_document(self, values: np.ndarray) -> np.ndarray:
        """Sums of the links' values by document."""
        return np.diff(np.r_[0, np.cumsum(values)][self.links_before])

    def groups(self) -> list[str]:
        """Each document's groups: a1,a2|b1;a3|b2 and so on."""
        a_to, b_to = self.group_ends
        a_in, b_in = np.diff(a_to, prepend=0), np.diff(b_to, prepend=0)
        b_before = b_to - b_in
        ids, mark = np.empty(len(self.a) + len(self.b), np.int64), np.full(len(self.a) + len(self.b), ord(","), np.uint8)
        place_a, place_b = np.arange(len(self.a)) + np.repeat(b_before, a_in), np.arange(len(self.b)) + np.repeat(a_to, b_in)
        ids[place_a], ids[place_b] = self.a, self.b
        mark[place_a[a_to - 1]], mark[place_b[b_to - 1]] = ord("|"), ord(";")
        printed, digits = _printed(int(ids.max(initial=0)) + 1)
        size, rows = digits[ids], printed[ids]
        rows[np.arange(len(ids)), size] = mark
        out, end = rows[np.arange(rows.shape[1]) <= size[:, None]], np.cumsum(size + 1)
        tokens = np.r_[0, np.cumsum(self.n_a + self.n_b)]
        edge = np.r_[0, end][tokens].tolist()
        return [out[x : max(x, y - 1)].tobytes().decode() for x, y in zip(edge, edge[1:], strict=False)]


def _by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of pairs by bucket, the buckets, and where each begins and the last ends in that order."""
    return by_bucket(_bucket(keys >> 32, keys & 0xFFFFFFFF, buckets).astype(np.uint32))


def _bucket(a: np.ndarray, b: np.ndarray, buckets: int) -> np.ndarray:
    return (a * 1_000_003 + b) % buckets


_ASKED = "bucket int, slice long, pairs binary, links binary"


def _asked(make: Callable[[], Pair], buckets: int):
    """The distinct pairs of each slice by bucket, and how often each is there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(make)
        for batch in batches:
            for row in batch.to_pylist():
                keys, n = np.unique(_Slice(row, pair).pairs, return_counts=True)
                order, held, cuts = _by_bucket(keys, buckets)
                keys, n = keys[order], n[order].astype("<u4")
                parts = [pa.array([packed(x[i:j]) for i, j in itertools.pairwise(cuts.tolist())], pa.binary()) for x in (keys, n)] if len(keys) else [pa.array([], pa.binary())] * 2
                yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array([row["slice"]] * len(held), pa.int64()), *parts], _ASKED.replace(",", "").split()[::2])

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of ids with their links, summed over the slices that a task has."""
    keys, n = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def summed() -> None:
        held, which = np.unique(np.concatenate(keys), return_inverse=True)
        keys[:], n[:] = [held], [np.bincount(which, np.concatenate(n), len(held)).astype(np.int64)]

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys[0] >> 32), pa.array(keys[0] & 0xFFFFFFFF), pa.array(n[0])], ["a", "b", "n"])

    for batch in batches:
        for pairs, links in zip(batch.column("pairs"), batch.column("links"), strict=True):
            keys.append(unpacked(pairs.as_buffer(), "<i8"))
            n.append(unpacked(links.as_buffer(), "<u4").astype(np.int64))
            if sum(map(len, keys)) > HELD_PAIRS:
                summed()
                if len(keys[0]) > HELD_PAIRS // 2:
                    yield rows()
                    keys[:], n[:] = [keys[0][:0]], [n[0][:0]]
    summed()
    yield rows()


def _answered(_: tuple[pa.Scalar, ...], asked: pa.Table, counts: pa.Table) -> pa.Table:
    """To each slice the counts of its pairs, and whether they are their B ids' highest."""
    key = (counts.column("a").to_numpy() << 32) | counts.column("b").to_numpy()
    order = np.argsort(key)
    key, n, best = key[order], counts.column("n").to_numpy()[order], counts.column("best").to_numpy()[order].astype(np.uint8)
    at = [np.searchsorted(key, unpacked(x.as_buffer(), "<i8")) for x in asked.column("pairs")]
    return pa.table({"slice": asked.column("slice"), "bucket": asked.column("bucket"), "n": pa.array([packed(n[x]) for x in at], pa.binary()), "best": pa.array([packed(best[x]) for x in at], pa.binary())})


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def _aligned(make: Callable[[], Pair], buckets: int):
    def run(_: tuple[pa.Scalar, ...], slices: pa.Table, answers: pa.Table) -> pa.Table:
        give_back()
        pair, out, answers = _pair(make), [], answers.sort_by("bucket")
        join = lambda c, kind: np.concatenate([np.zeros(0, kind), *(unpacked(x.as_buffer(), kind) for x in answers.column(c))])
        for row in slices.to_pylist():
            s = _Slice(row, pair)
            keys, at = np.unique(s.pairs, return_inverse=True)
            order, n, best = _by_bucket(keys, buckets)[0], np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
            n[order], best[order] = join("n", "<i8"), join("best", np.uint8)
            own = [s.n_a, s.n_b, np.diff(s.cuts_before), np.diff(s.links_before), s.per_document(best[at]), s.per_document(n[at])]
            out.append(pa.table([pa.array(s.ids, pa.int64(), mask=s.nulls), *(pa.array(x, pa.int64()) for x in own), pa.array(s.groups(), pa.string())], _RESULT.replace(",", "").split()[::2]))
        return pa.concat_tables(out) if out else pa.table([pa.array([], t) for t in (*[pa.int64()] * 7, pa.string())], _RESULT.replace(",", "").split()[::2])

    return run


def align(docs: DataFrame, make: Callable[[], Pair] = public_pair) -> DataFrame:
    """Both tokenizers' tokens of each text and how they go together; one row for each input row.

    doc_id, n_a and n_b (tokens), n_groups (stretches between bytes at which tokens of both end), n_links (pairs of an A and a B token
    that share bytes), n_best (links whose pair of ids is among the most frequent of its B id, over all texts), count_sum (the links'
    pairs' frequencies) and groups (`a1,a2|b1;a3|b2`: ids in order). A text that is null or empty, or that the joined tokens of
    either side don't give back, has no tokens: zeros and an empty string. Rows without doc_id and repeated ids count by their own
    text. Other columns are left out.
    """
    spark = docs.sparkSession
    small_batches(spark)
    buckets = parts_for(spark, text_bytes(docs), BUCKET)
    slices = saved(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_encoded(make), _SLICE_ROW), "align_slices")
    asked = saved(slices.mapInArrow(_asked(make, buckets), _ASKED), "align_asked")
    counts = saved(asked.select("pairs", "links").mapInArrow(_counted, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")), "align_counts")
    best = counts.groupBy("b").agg(F.max("n").alias("most"))
    known = counts.join(best, "b").select((F.pmod(F.col("a") * 1_000_003 + F.col("b"), F.lit(buckets))).cast("int").alias("bucket"), "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))
    asking = asked.select("bucket", "slice", "pairs").groupBy("bucket")
    answers = saved(asking.cogroup(known.groupBy("bucket")).applyInArrow(_answered, "slice long, bucket int, n binary, best binary"), "align_answers")
    forget(asked)
    forget(counts)
    return slices.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(_aligned(make, buckets), _RESULT)


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return align(table(spark, sf_dir, "documents")).withColumn("groups_sha256", digest).drop("groups")
