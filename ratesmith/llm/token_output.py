"""Token ids of documents in flat files of Simple-8b blocks, and their reader.

A file holds blocks one after the other, each followed by a line feed. A block is, little-endian: the magic S8B1, u32 documents,
u32 sub-blocks, u64 ids, u64 words; for each document i64 doc_id, u32 ids in this block and u8 flags (1: doc_id is null, 2: the
document goes on in the next block); for each sub-block of 1024 ids u32, the word at which it begins; then the u64 words.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import simple8b
from .common import freed_shuffles, parts_for, saved, table, text_bytes, work_path
from .shingles import SPACES, Words, distinct, eights, give_back, new_key, same_bytes, text_slices, words

MAGIC, HEAD = b"S8B1", struct.Struct("<4sIIQQ")
BLOCK_IDS = 1 << 18
NULL, MORE = 1, 2
#: Distinct pieces of text whose ids a Python worker keeps; when there are more, those of one slice of text go.
CACHE_PIECES = 700_000
END_ID = 2
#: Bytes of text that are encoded at a time: what numpy holds meanwhile is some sixty times that, and larger slices have fewer
#: distinct pieces in all.
SLICE = 1 << 20
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(0x21, 0x27), *range(0x28, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = True
#: Marks at a word's end that are looked at; a word with more of them stays whole.
_TAIL = 4
_SMALL = np.zeros(256, bool)
_SMALL[0x61:0x7B] = True
#: Second bytes of the small letters from U+00DF to U+00FF, whose first is 0xC3.
_SECOND = np.zeros(256, bool)
_SECOND[[*range(0x9F, 0xB7), *range(0xB8, 0xC0)]] = True


def _letters(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to small letters, ASCII or Latin-1: the pre-tokenizer keeps a piece of those whole."""
    out = _SMALL[data]
    pair = (data[:-1] == 0xC3) & _SECOND[data[1:]]
    out[:-1] |= pair
    out[1:] |= pair
    return out


def _lower_latin(w: Words) -> Words:
    """Capitals from U+00C0 to U+00DE as small letters, in place: the tokenizer lowers all letters, but the cache should know one form."""
    second = w.data[1:]
    second[(w.data[:-1] == 0xC3) & (second <= 0x9E) & (second >= 0x80) & (second != 0x97)] += np.uint8(0x20)
    return w


def _pieces(w: Words) -> Words:
    """Words cut in two where their end is ASCII punctuation after an ASCII letter or digit: the pre-tokenizer cuts there too,
    whatever stands before. Apostrophes are left alone, because of 's and the like."""
    if not len(w.start):
        return w
    tail, open_ = w.end.copy(), np.arange(len(w.end))
    for _ in range(_TAIL):
        open_ = open_[_PUNCTUATION[w.data[tail[open_] - 1]] & (tail[open_] > w.start[open_])]
        tail[open_] -= 1
    tail = np.maximum(tail, w.start)
    cut = (tail > w.start) & (tail < w.end) & _ALNUM[w.data[tail - 1]]
    at = np.arange(len(cut)) + np.cumsum(cut) - cut  # where each word's first piece stands
    start, end = np.empty(len(cut) + int(cut.sum()), np.int64), np.empty(len(cut) + int(cut.sum()), np.int64)
    start[at], end[at] = w.start, np.where(cut, tail, w.end)
    start[at[cut] + 1], end[at[cut] + 1] = tail[cut], w.end[cut]
    return Words(w.data, start, end, np.r_[at, len(start)][w.first])


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for size[0] places, then the same for the others."""
    to = np.cumsum(size)
    return np.arange(to[-1] if len(to) else 0) + np.repeat(start - (to - size), size)


class PieceCache:
    """Some integers for each distinct piece of text. Pieces are found by a keyed hash and compared byte by byte."""

    def __init__(self):
        self.bits, self.key = 21, new_key()
        self._reset(np.zeros(0, np.int64))

    def slots(self, d: Words, learn: Callable[[Words, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        """The slots of the distinct pieces d. learn gets those that aren't known, and gives an order of them, the number of each
        one's integers, and all integers."""
        keys = d.keyed_hashes(self.key)
        slot = self._find(keys, d)
        if self.n > CACHE_PIECES and (slot < 0).any():
            self._reset(np.flatnonzero(self.uses[: self.n] > 1))
            slot = self._find(keys, d)
        if len(new := np.flatnonzero(slot < 0)):
            order, size, ids = learn(d, new)
            slot[order] = np.arange(self.n, self.n + len(order))
            self._add(keys[order], d, order, size, ids)
        self.uses[slot] += 1  # slices of text that a piece is in
        return slot

    def _reset(self, keep: np.ndarray) -> None:
        """Keep these slots only."""
        old = None
        if len(keep):
            to = np.cumsum(self.bytes[keep])
            kept = Words(self.text[_ragged(self.at[keep], self.bytes[keep])], to - self.bytes[keep], to, np.array([0, len(keep)]))
            old = (self.keys[keep], kept, np.arange(len(keep)), self.size[keep], self.flat[_ragged(self.start[keep], self.size[keep])])
        self.table, self.n = np.full(1 << self.bits, -1, np.int32), 0
        room = max(1 << 16, 2 * len(keep))
        self.keys = np.zeros(room, np.uint64)
        self.at, self.bytes, self.start, self.size, self.uses = (np.zeros(room, np.int32) for _ in range(5))
        self.flat, self.used, self.text, self.filled = np.zeros(1 << 20, np.uint32), 0, np.zeros((1 << 20) + 8, np.uint8), 0
        if old:
            self._add(*old)

    def _add(self, keys: np.ndarray, w: Words, of: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        """Remember the words `of` of w, which have these keys, numbers of ids, and ids."""
        k, length = len(keys), w.end[of] - w.start[of]
        while self.n + k > len(self.keys):
            for name in ("keys", "at", "bytes", "start", "size", "uses"):
                setattr(self, name, np.concatenate([x := getattr(self, name), np.zeros_like(x)]))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.filled + int(length.sum()) + 8 > len(self.text):
            self.text = np.concatenate([self.text, np.zeros_like(self.text)])
        new = slice(self.n, self.n + k)
        self.keys[new], self.size[new], self.bytes[new] = keys, size, length
        self.start[new], self.at[new] = self.used + np.cumsum(size) - size, self.filled + np.cumsum(length) - length
        self.flat[self.used : self.used + len(ids)] = ids
        self.text[self.filled : self.filled + int(length.sum())] = w.data[_ragged(w.start[of], length)]
        self.used, self.filled = self.used + len(ids), self.filled + int(length.sum())
        left, at, mask = np.arange(self.n, self.n + k), (self.keys[new] >> np.uint64(8)).astype(np.int64), (1 << self.bits) - 1
        while len(left):  # linear probing, all at once; of those that meet at one place the last stays
            at &= mask
            free = self.table[at] < 0
            self.table[at[free]] = left[free]
            go = self.table[at] != left
            left, at = left[go], at[go] + 1
        self.n += k

    def _find(self, keys: np.ndarray, w: Words) -> np.ndarray:
        """The slots of the words of w, -1 where there is none."""
        out, mask, length = np.full(len(keys), -1, np.int32), (1 << self.bits) - 1, w.end - w.start
        left, at = np.arange(len(keys)), (keys >> np.uint64(8)).astype(np.int64)
        mine, theirs = eights(self.text, padded=True), eights(w.data)
        while len(left):
            at &= mask
            slot = self.table[at]
            hit = (slot >= 0) & (self.keys[slot] == keys[left]) & (self.bytes[slot] == length[left])
            of = left[hit]
            hit[hit] = same_bytes(mine, self.at[slot[hit]], theirs, w.start[of], length[of])
            out[left[hit]] = slot[hit]
            go = (slot >= 0) & ~hit
            left, at = left[go], at[go] + 1
        return out


class PieceEncoder(PieceCache):
    """Ids of whole texts by a byte-level tokenizer that lowers case, marks the last token of a pre-token, and never lets a token cross
    ASCII white space: each distinct piece is encoded once, with the tokenizers library."""

    def __init__(self, path: str, end_of_word: str = "</w>"):
        super().__init__()
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.tokenizer.model)  # for pieces that its normaliser and its patterns leave as they are
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith(end_of_word)]] = True

    def _encoded(self, w: Words, new: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pieces `new` in an order of their own, the number of each one's ids, and all ids. Pieces of letters only go to the
        tokenizer in one text, and come apart at the tokens that end a pre-token."""
        others = np.r_[0, np.cumsum(~_letters(w.data), dtype=np.int32)]
        plain = others[w.end[new]] == others[w.start[new]]
        own, ids, size = new[plain], np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(own):
            room = w.end[own] - w.start[own] + 1
            joined = np.append(w.data, np.uint8(0x20))[_ragged(w.start[own], room)]
            joined[np.cumsum(room) - 1] = 0x20
            ids = np.array(self.plain.encode_batch_fast([joined[:-1].tobytes().decode()], add_special_tokens=False)[0].ids, np.uint32)
            size = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
            if len(size) != len(own):
                own, plain, ids, size = own[:0], np.zeros(len(new), bool), ids[:0], size[:0]
        rest = new[~plain]
        more = [e.ids for e in self.tokenizer.encode_batch_fast([w.data[a:b].tobytes().decode() for a, b in zip(w.start[rest].tolist(), w.end[rest].tolist(), strict=True)], add_special_tokens=False)]
        return np.concatenate([own, rest]), np.concatenate([size, np.array([len(x) for x in more], np.int64)]), np.concatenate([ids, np.array([y for x in more for y in x], np.uint32)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of each text's ids."""
        # special tokens are looked for in the text as it is: their upper case must not be lowered before
        special = pc.any(pc.match_substring(texts, "<|")).as_py()
        w = words(texts, SPACES) if special else _pieces(_lower_latin(words(texts, SPACES, lower=True)))
        d, which = distinct(w)
        slot = self.slots(d, self._encoded)[which]
        size = self.size[slot]
        to = np.cumsum(size)
        ids = self.flat[_ragged(self.start[slot], size)]
        to = np.r_[0, to]
        return ids, to[w.first[1:]] - to[w.first[:-1]]


def word_bpe() -> PieceEncoder:
    import public_tokenizers

    return PieceEncoder(public_tokenizers.path("word_bpe_49k.json"))


def pack_block(docs: list[tuple[int | None, int, bool]], ids: np.ndarray) -> bytes:
    words, offsets = simple8b.encode(ids)
    head = HEAD.pack(MAGIC, len(docs), len(offsets), len(ids), len(words))
    return b"".join([
        head, np.array([d or 0 for d, _, _ in docs], "<i8").tobytes(), np.array([n for _, n, _ in docs], "<u4").tobytes(),
        np.array([NULL * (d is None) + MORE * more for d, _, more in docs], np.uint8).tobytes(), offsets.astype("<u4").tobytes(), words.astype("<u8").tobytes(),
    ])


def read_blocks(raw: bytes | memoryview) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(doc_ids, ids in the block, flags, ids) of each block of a file."""
    at = 0
    while at < len(raw):
        magic, docs, subs, n, words = HEAD.unpack_from(raw, at)
        if magic != MAGIC:
            raise ValueError(f"no block at byte {at}")
        at, parts = at + HEAD.size, []
        for count, kind in ((docs, "<i8"), (docs, "<u4"), (docs, "u1"), (subs, "<u4"), (words, "<u8")):
            parts.append(np.frombuffer(raw, kind, count, at))
            at += parts[-1].nbytes
        at += 1
        yield parts[0], parts[1], parts[2], simple8b.decode(parts[4].astype(np.uint64), parts[3], n)


def _blocks(make: Callable[[], PieceEncoder], end_id: int, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = globals().setdefault("_encoders", {}).setdefault(make, None) or make()
        globals()["_encoders"][make] = encoder
        docs, held, n = [], [], 0

        def flush(most: int) -> pa.RecordBatch:
            nonlocal docs, held, n
            ids, own, left = np.concatenate(held), [], most
            while docs and (left > 0 or docs[0][1] == 0):
                d, size = docs.pop(0)
                own.append((d, min(size, left), size > left))
                if size > left:
                    docs.insert(0, (d, size - left))
                left -= min(size, left)
            held, n = [ids[most:]], n - most
            return pa.RecordBatch.from_arrays([pa.array([pack_block(own, ids[:most])], pa.binary())], ["block"])

        for batch in batches:
            for a, b in text_slices(batch, most=SLICE):
                ids, sizes = encoder.encode(batch.column("text").slice(a, b - a))
                ends = np.cumsum(sizes)
                docs += zip(batch.column("doc_id").slice(a, b - a).to_pylist(), (sizes + 1).tolist(), strict=True)
                held.append(np.insert(ids, ends, end_id))
                n += len(held[-1])
                while n >= block_ids:
                    yield flush(block_ids)
        if n:
            yield flush(n)

    return run


def write_tokens(docs: DataFrame, path: str, make: Callable[[], PieceEncoder] = word_bpe, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of all texts, each with end_id after it, into files of `path` in ascending order of doc_id.

    A null or empty text has the end id alone. Rows without doc_id come first; rows with one doc_id follow each other, in the
    order of a hash of their texts. Other columns are left out.
    """
    parts = parts_for(docs.sparkSession, text_bytes(docs))
    rows = docs.select("doc_id", "text").repartitionByRange(parts, F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"), F.xxhash64("text"))
    with freed_shuffles(docs.sparkSession):
        rows.mapInArrow(_blocks(make, end_id, block_ids), "block binary").select(F.col("block").cast("string").alias("value")).write.text(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, raw in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            give_back()
            file = path.rsplit("/", 1)[-1]  # names sort as the files were written, also where a task writes several
            start = size = crc = 0
            for ids, sizes, flags, values in read_blocks(raw.as_buffer()):
                data, at, out = values.astype("<u4"), 0, []
                for d, k, flag in zip(ids.tolist(), sizes.tolist(), flags.tolist(), strict=True):
                    crc, size, at = zlib.crc32(data[at : at + k], crc), size + k, at + k
                    if not flag & MORE:
                        out.append((file, None if flag & NULL else d, start, size, crc))
                        start, size, crc = start + size, 0, 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.string(), *[pa.int64()] * 4), strict=True)], ["file", "doc_id", "start", "n_tokens", "ids_crc32"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of each document in the files of write_tokens()."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0").select("path", "content")
    rows = saved(files.mapInArrow(_documents, "file string, doc_id long, start long, n_tokens long, ids_crc32 long"), "token_rows")
    # one row for each file; a file has some 16 MB of text or a whole longer document
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    total = rows.groupBy("file").agg(F.sum("n_tokens").alias("n")).select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(total, "file").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path)
    return read_tokens(spark, path)
