"""Words and word-window fingerprints of whole texts, computed in numpy on Arrow buffers inside tasks."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import hashlib
import secrets
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: All ASCII but digits and small letters: for texts in lower case.
NOT_LOWER_ALNUM = np.zeros(256, bool)
NOT_LOWER_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
#: A-Z to a-z, byte by byte; bytes of other characters are over 0x7F in UTF-8.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_SLICE = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bytes up to which a word is hashed together with others.
LONG = 256
_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _constants(n: int, seed: int) -> np.ndarray:
    """n odd numbers that look random, other ones for each seed."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64((seed + 1) * 100_003)) * _STEP) | np.uint64(1)


def new_key() -> bytes:
    """A secret key for keyed hashes, drawn anew: nobody can make texts for it beforehand."""
    return secrets.token_bytes(16)


@functools.lru_cache(64)
def _secrets(key: bytes, n: int, name: str) -> np.ndarray:
    """n random integers of 64 bits that follow from a key."""
    return np.frombuffer(hashlib.shake_256(name.encode() + b"\0" + key).digest(8 * n), "<u8").astype(np.uint64)


def eights(data: np.ndarray, padded: bool = False) -> np.ndarray:
    """The eight bytes from each byte on as integers. padded: data has eight more bytes at its end, which need not be copied."""
    if not padded:
        data = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) - 7, "<u8", data, strides=(1,))


def _steps(eight: np.ndarray, start: np.ndarray, size: np.ndarray, open_: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Byte strings in steps of eight bytes: which of open_ have bytes there, and these bytes as integers."""
    at = 0
    while len(open_):
        left = size[open_] - at
        yield open_, eight[start[open_] + at] & _MASKS[np.minimum(left, 8)]
        open_, at = open_[left > 8], at + 8


@dataclass
class Words:
    """Words of some texts. first[i]:first[i + 1] are the words of text i, data[start[j]:end[j]] are the bytes of word j."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def keyed_hashes(self, key: bytes, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes under a secret key; seeds are independent of each other.

        Two sums of the word's 32-bit parts and its length, each with random multipliers of 64 bits, of which the upper 32 bits
        count (multilinear hashing): any two words agree with a chance of at most 2 ** -64 over the keys, whatever they are.
        Words of more than LONG bytes are hashed by BLAKE2 with the key.
        """
        size, low = self.end - self.start, np.uint64(0xFFFFFFFF)
        k = _secrets(key, 2 * (LONG // 4 + 2), f"words{seed}").reshape(2, -1)
        sums = [a[-1] + size.astype(np.uint64) * a[-2] for a in k]
        long = size > LONG
        for step, (open_, part) in enumerate(_steps(eights(self.data), self.start, size, np.flatnonzero(~long))):
            lower, upper = part & low, part >> np.uint64(32)
            for s, a in zip(sums, k, strict=True):
                s[open_] += lower * a[2 * step] + upper * a[2 * step + 1]
        out = (sums[0] & ~low) | (sums[1] >> np.uint64(32))
        for i in np.flatnonzero(long):
            out[i] = int.from_bytes(hashlib.blake2b(self.data[self.start[i] : self.end[i]], digest_size=8, key=key, person=seed.to_bytes(2, "little")).digest(), "little")
        return out

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word's bytes that is the same in all runs, for features; seeds are independent of each other.

        Words are taken in steps of eight bytes, each mixed with all before it by a bijection that isn't linear: words of one
        length up to eight bytes never have equal hashes, but longer ones can be made that do. Words of more than LONG bytes are
        hashed by BLAKE2.
        """
        size = self.end - self.start
        out = mix(size.astype(np.uint64) * _STEP + _constants(1, seed)[0])
        long = size > LONG
        for open_, part in _steps(eights(self.data), self.start, size, np.flatnonzero(~long)):
            out[open_] = mix(out[open_] ^ part)
        key = int(_constants(1, seed)[0]).to_bytes(8, "little")
        for i in np.flatnonzero(long):
            out[i] = int.from_bytes(hashlib.blake2b(self.data[self.start[i] : self.end[i]], digest_size=8, key=key).digest(), "little")
        return out

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def distinct(w: Words) -> tuple[Words, np.ndarray]:
    """The distinct words of w, told apart by their bytes, and which of them each word is."""
    if not len(w.start):
        return Words(w.data[:0], w.start, w.end, np.zeros(1, np.int64)), np.zeros(0, np.int64)
    cuts = np.empty(2 * len(w.start) + 1, np.int64)
    cuts[:-1:2], cuts[1::2], cuts[-1] = w.start, w.end, w.end[-1]  # words and what is between them, in turns
    both = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(w.data))]).dictionary_encode()
    which, offsets = both.indices.to_numpy()[::2], np.frombuffer(both.dictionary.buffers()[1], np.int64)[: len(both.dictionary) + 1]
    used = np.zeros(len(both.dictionary), bool)
    used[which] = True
    number = np.cumsum(used) - 1
    data = np.frombuffer(both.dictionary.buffers()[2] or b"", np.uint8)
    return Words(data, offsets[:-1][used], offsets[1:][used], np.array([0, int(used.sum())])), number[which]


def same_bytes(a: np.ndarray, a_start: np.ndarray, b: np.ndarray, b_start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether a and b, both made by eights(), hold equal bytes from a_start and b_start on, for each place of the last three."""
    out = np.ones(len(size), bool)
    for (open_, x), (_, y) in zip(_steps(a, a_start, size, rows := np.arange(len(size))), _steps(b, b_start, size, rows), strict=True):
        out[open_[x != y]] = False
    return out


def text_slices(batch: pa.RecordBatch, column: str = "text", most: int = _SLICE) -> Iterator[tuple[int, int]]:
    """Rows of a batch by ranges of about `most` bytes of text, one row at least."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    yield from zip(cuts, cuts[1:], strict=False)
    give_back()


def give_back() -> None:
    """Return memory that is free to the system: a Python worker shares its executor's bound with the JVM and with other workers."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def words(texts: pa.Array, breaks: np.ndarray = SPACES, lower: bool = False) -> Words:
    """Words of each text: its longest runs of bytes that are no breaks. A null text has none."""
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = (np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8))[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if lower:
        data = LOWER[data]
    inside = ~breaks[data]
    change = np.zeros(len(data) + 1, bool)
    change[1:-1] = inside[1:] != inside[:-1]
    if len(data):
        change[0] = change[-1] = True
    change[offsets] = True
    edges = np.flatnonzero(change)
    left, right = (edges[:-1], edges[1:]) if len(data) else (edges[:0], edges[:0])
    keep = inside[left]
    start, end = left[keep], right[keep]
    return Words(data, start, end, np.searchsorted(start, offsets))


def windows(hashes: np.ndarray, first: np.ndarray, k: int, short: bool = False, seed: int = 0, key: bytes | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and first word of each window of k words. short: a text of fewer words, but not none, is one window.

    A window's hash is a sum of its words' hashes, each place with a multiplier of its own, mixed. With a key the multipliers
    are secret.
    """
    n, weights = len(hashes), _constants(k + 1, seed + 13) if key is None else _secrets(key, k + 1, f"windows{seed}") | np.uint64(1)
    acc = np.zeros(max(0, n - k + 1), np.uint64)
    for j in range(k):
        acc += hashes[j : n - k + 1 + j] * weights[j] if n >= k else acc
    counts = np.diff(first)
    each = np.maximum(counts - k + 1, 0)
    text = np.repeat(np.arange(len(counts)), each)
    at = np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each) + first[:-1][text]
    out = mix(acc[at]) if len(at) else np.zeros(0, np.uint64)
    if short and len(few := np.flatnonzero((counts > 0) & (counts < k))):
        extra = counts[few].astype(np.uint64) * weights[k]
        for j in range(k - 1):
            has = counts[few] > j
            extra[has] += hashes[first[few[has]] + j] * weights[j]
        out, text, at = np.concatenate([out, mix(extra)]), np.concatenate([text, few]), np.concatenate([at, first[few]])
        order = np.argsort(text, kind="stable")
        out, text, at = out[order], text[order], at[order]
    return out, text, at


def by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A stable order by bucket, the buckets present, and where each begins and the last ends in that order."""
    order = np.argsort(bucket.astype(np.uint16) if bucket.size and bucket.max() < 1 << 16 else bucket, kind="stable")
    held = bucket[order]
    cuts = np.flatnonzero(np.r_[True, held[1:] != held[:-1]]) if len(held) else np.zeros(0, np.int64)
    return order, held[cuts], np.r_[cuts, len(held)]


_CLASS = np.full(256, 8, np.uint8)  # punctuation and controls; of other characters each byte counts as a small letter
_CLASS[SPACES] = 0
_CLASS[0x30:0x3A] = 4
_CLASS[0x41:0x5B] = 2
_CLASS[0x61:0x7B] = 1
_CLASS[0x80:] = 1


def shapes(w: Words, hashes: np.ndarray) -> np.ndarray:
    """A hash of each word's form: its kinds of characters, a first capital, its last two marks, and whether it is the word before again."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    kind = _CLASS[w.data]
    form = np.bitwise_or.reduceat(kind, w.start).astype(np.uint64)
    last, near = w.data[w.end - 1].astype(np.uint64), w.data[np.maximum(w.end - 2, w.start)].astype(np.uint64)
    form |= np.where(kind[w.end - 1] == 8, last, 0).astype(np.uint64) << np.uint64(8) | np.where(kind[np.maximum(w.end - 2, w.start)] == 8, near, 0).astype(np.uint64) << np.uint64(16)
    form |= (kind[w.start] == 2).astype(np.uint64) << np.uint64(4) | np.minimum(w.end - w.start, 2).astype(np.uint64) << np.uint64(24)
    again = np.r_[False, hashes[1:] == hashes[:-1]]
    again[w.first[w.first < len(hashes)]] = False  # a text's first word has none before it
    form |= again.astype(np.uint64) << np.uint64(5)
    return mix((form + np.uint64(1)) * _STEP)
