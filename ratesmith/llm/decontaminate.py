"""Benchmark decontamination: documents stream through a generalised suffix automaton of the normalised benchmark items.

Items are dealt to blocks by a hash, tasks build each block's automaton and write it to a working table, and documents pass a few
automata at a time, so that neither the driver nor a task ever holds more of the benchmark than PASS automata.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import forget, saved, small_batches, table
from .shingles import NOT_LOWER_ALNUM, text_slices, words

WINDOW = 10
#: Words of benchmark items in one automaton, about; more items make more automata.
BLOCK_WORDS = 100_000
#: Automata that documents meet in one pass; the driver and a task hold as many.
PASS = 2
#: A document with a larger share of hit words goes as a whole.
MAX_COVERAGE = 0.5
ORACLE_NAME = "op10_benchmark_decontamination"


class ItemAutomaton:
    """All factors of some items, and which items hold each factor of `window` words."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.window = window
        self.vocab = {w: i for i, w in enumerate(dict.fromkeys(w for _, ws in items for w in ws))}
        self.ids = [i for i, _ in items]
        self.go: list[dict[int, int]] = [{}]
        self.link, self.length, holders = [-1], [0], [set()]
        ends: list[tuple[int, int, int]] = []
        for n, (_, item) in enumerate(items):
            last = 0
            for word in item:
                last = self._extend(last, self.vocab[word], holders)
                holders[last].add(n)
            if 0 < len(item) < window:
                ends.append((last, len(item), n))
        order = sorted(range(1, len(self.go)), key=self.length.__getitem__, reverse=True)
        self.window_state, self.holders = [-1] * len(self.go), {}
        #: Whole items that are shorter than a window, by state, and the next state up the links that has some.
        self.whole: dict[int, list[tuple[int, int]]] = {}
        for s, size, n in ends:
            self.whole.setdefault(s, []).append((size, n))
        for s in order:  # longest first: a state's items are complete when it is reached
            up = self.link[s]
            if self.length[s] >= window > self.length[up]:
                self.window_state[s] = s
                self.holders[s] = tuple(sorted(holders[s]))
            elif self.length[up] >= window:
                holders[up] |= holders[s]
            holders[s] = set()
        self.whole_up = [-1] * len(self.go)
        for s in reversed(order):
            up = self.link[s]
            if self.length[up] >= window:
                self.window_state[s] = self.window_state[up]
            self.whole_up[s] = up if up in self.whole else self.whole_up[up] if up > 0 else -1
        self.shortest = min([window, *(size for _, size, _ in ends)])

    def _new(self, length: int, go: dict, link: int, holders: list) -> int:
        self.go.append(go)
        self.length.append(length)
        self.link.append(link)
        holders.append(set())
        return len(self.go) - 1

    def _split(self, p: int, q: int, c: int, holders: list) -> int:
        """The state of the longest factor of q that p + c reaches."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._new(self.length[p] + 1, dict(self.go[q]), self.link[q], holders)
        self.link[q] = clone
        while p >= 0 and self.go[p].get(c) == q:
            self.go[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int, holders: list) -> int:
        if c in self.go[last]:
            return self._split(last, self.go[last][c], c, holders)
        cur, p = self._new(self.length[last] + 1, {}, 0, holders), last
        while p >= 0 and c not in self.go[p]:
            self.go[p][c] = cur
            p = self.link[p]
        if p >= 0:
            self.link[cur] = self._split(p, self.go[p][c], c, holders)
        return cur

    def matches(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set[int], int]:
        """Ranges of words inside occurring windows, the numbers of those windows' items, and the longest matching length."""
        go, link, length, k = self.go, self.link, self.length, self.window
        s = size = longest = 0
        ranges: list[tuple[int, int]] = []
        found: set[int] = set()
        states: set[int] = set()
        for i, word in enumerate(text):
            c = self.vocab.get(word)
            if c is None:
                s = size = 0
                continue
            while s and c not in go[s]:
                s = link[s]
                size = length[s]
            if c in go[s]:
                s = go[s][c]
                size += 1
            longest = max(longest, size)
            reach = 0
            if size >= k:
                reach = k
                states.add(self.window_state[s])
            u = s if s in self.whole else self.whole_up[s]
            while u > 0:
                for m, n in self.whole[u]:
                    if m <= size:
                        reach = max(reach, m)
                        found.add(n)
                u = self.whole_up[u]
            if reach:
                a = i + 1 - reach
                if ranges and a <= ranges[-1][1]:
                    ranges[-1] = (min(a, ranges[-1][0]), i + 1)
                else:
                    ranges.append((a, i + 1))
        for x in states:
            found.update(self.holders[x])
        return ranges, found, longest


def normalised(text: str | None) -> list[bytes]:
    w = words(pa.array([text], pa.string()), NOT_LOWER_ALNUM, lower=True)
    return [w.data[a:b].tobytes() for a, b in zip(w.start, w.end, strict=True)]


def _built(window: int):
    """The automaton of one block of items, pickled and compressed."""

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        t = t.sort_by([("item_id", "ascending"), ("text", "ascending")])
        items = [(i, item) for i, text in zip(t.column("item_id").to_pylist(), t.column("text").to_pylist(), strict=True) if (item := normalised(text))]
        made = [zlib.compress(pickle.dumps(ItemAutomaton(items, window)), 1)] if items else []
        return pa.table({"block": pa.array([key[0].as_py()] * len(made), pa.int64()), "automaton": pa.array(made, pa.binary())})

    return run


def item_automata(benchmark: DataFrame, window: int, block_words: int) -> DataFrame:
    """(block, automaton) of all items, in a working table. A block is a hash's share of the items, of about block_words words."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text IS NOT NULL")
    total = items.agg(F.coalesce(F.sum(F.size(F.split("text", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))), F.lit(0)).alias("n")).first()["n"]
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, -(-total // block_words))))
    return saved(items.withColumn("block", block).groupBy("block").applyInArrow(_built(window), "block long, automaton binary"), "automata")


def _stream(automaton):
    """Add each text's hit byte ranges and items of one automaton. Only runs of item words that are long enough for a window are streamed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto: ItemAutomaton = pickle.loads(zlib.decompress(automaton.value))
        known = words(pa.array([b" ".join(auto.vocab).decode()]), NOT_LOWER_ALNUM)
        vocab = np.sort(known.hashes())
        likely = np.zeros(1 << 22, bool)
        likely[vocab >> np.uint64(42)] = True
        for batch in batches:
            for a, b in text_slices(batch):
                part = batch.slice(a, b - a)
                w = words(part.column("text"), NOT_LOWER_ALNUM, lower=True)
                h = w.hashes()
                ours = likely[h >> np.uint64(42)]
                at = np.flatnonzero(ours)
                ours[at] = vocab[np.minimum(np.searchsorted(vocab, h[at]), len(vocab) - 1)] == h[at]
                # runs of item words inside one text
                edge = np.zeros(len(h) + 1, bool)
                edge[w.first] = True
                edge[1:-1] |= ours[1:] != ours[:-1]
                cuts = np.flatnonzero(edge)
                left, right = cuts[:-1], cuts[1:]
                runs = np.flatnonzero(ours[left] & (right - left >= auto.shortest)) if len(h) else []
                doc = np.searchsorted(w.first, left[runs], "right") - 1 if len(h) else []
                spans = [[(x["a"], x["b"]) for x in own] for own in part.column("spans").to_pylist()]
                items, longest = part.column("items").to_pylist(), part.column("longest").to_pylist()
                for r, d in zip(runs, doc, strict=True):
                    x, y = int(left[r]), int(right[r])
                    low = int(w.start[x])
                    raw = w.data[low : w.end[y - 1]].tobytes()
                    s, e = (w.start[x:y] - low).tolist(), (w.end[x:y] - low).tolist()
                    ranges, found, length = auto.matches([raw[p:q] for p, q in zip(s, e, strict=True)])
                    longest[d] = max(longest[d], length)
                    base = int(w.first[d])
                    spans[d] = spans[d] + [(x + p - base, x + q - base) for p, q in ranges]
                    items[d] = items[d] + [auto.ids[n] for n in found if auto.ids[n] is not None]
                cols = {**{c: part.column(c) for c in part.schema.names}, "spans": pa.array([[{"a": p, "b": q} for p, q in x] for x in spans], part.schema.field("spans").type), "items": pa.array(items, part.schema.field("items").type), "longest": pa.array(longest, pa.int64())}
                yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    return run


def _cleaned(max_coverage: float):
    """Word counts, hit words and the text without hit spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in text_slices(batch):
                part = batch.slice(x, y - x)
                w = words(part.column("text"), NOT_LOWER_ALNUM, lower=True)
                texts, spans = part.column("text"), part.column("spans").to_pylist()
                n, hits, cleaned = w.counts(), np.zeros(len(spans), np.int64), []
                for i, own in enumerate(spans):
                    if not own:
                        cleaned.append(texts[i].as_py())
                        continue
                    raw, base = texts[i].as_py().encode(), int(w.first[i])
                    skip = words(texts.slice(i, 1), NOT_LOWER_ALNUM, lower=True)
                    merged: list[list[int]] = []
                    for s in sorted((s["a"], s["b"]) for s in own):
                        if merged and s[0] <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], s[1])
                        else:
                            merged.append(list(s))
                    hits[i] = sum(b - a for a, b in merged)
                    out, last = [], 0
                    for a, b in merged:
                        out.append(raw[last : skip.start[a]])
                        last = int(skip.end[b - 1])
                    cleaned.append(b"".join([*out, raw[last:]]).decode() if hits[i] <= max_coverage * n[i] else None)
                cols = {c: part.column(c) for c in part.schema.names if c != "spans"}
                yield pa.RecordBatch.from_arrays([*cols.values(), pa.array(n.astype(np.int64)), pa.array(hits), pa.array(cleaned, pa.string())], [*cols, "n_words", "n_hit", "cleaned"])

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Find and cut the benchmark passages of each document.

    Words are runs of ASCII letters and digits (A-Z as a-z) and other characters. A window is `window` consecutive words of an
    item; a shorter item is one window. Returns the columns of docs and: n_words, n_hit (words inside an occurring window),
    items (ids, as strings, of the items with occurring windows), longest (most words in a row that some item also has, in runs
    long enough for a window), cleaned (the text without hit spans; null where over `max_coverage` of the words are hit).
    Null or empty texts have no words and no hits, null or empty items no windows; items without an id hit but aren't named;
    repeated ids are named once. Columns of docs with the names of those that are added are replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    automata = item_automata(benchmark, window, block_words)
    blocks = sorted(r["block"] for r in automata.select("block").collect())  # a number for each automaton
    added = ["spans", "items", "longest", "n_words", "n_hit", "cleaned"]
    docs = docs.drop(*added)
    rows = docs.withColumns({"spans": F.array().cast("array<struct<a:long,b:long>>"), "items": F.array().cast("array<string>"), "longest": F.lit(0).cast("long")})
    held = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    before = None
    for at in range(0, len(blocks), PASS):
        if at:  # what the passes before have found, with the documents; the last pass needs no table
            rows = saved(rows, "decontaminated")
            for x in sent:
                x.destroy()
            if before is not None:
                forget(before)
            before = rows
        sent = [spark.sparkContext.broadcast(r["automaton"]) for r in automata.where(F.col("block").isin(blocks[at : at + PASS])).collect()]  # some MB each
        for x in sent:
            rows = rows.mapInArrow(_stream(x), held)
    out = T.StructType([f for f in held if f.name != "spans"]).add("n_words", "long").add("n_hit", "long").add("cleaned", "string")
    return rows.mapInArrow(_cleaned(max_coverage), out).withColumn("items", F.array_sort(F.array_distinct("items")))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE = {
    ORACLE_NAME: """
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark
), x AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS k, array_to_string(words[i:i + 9], ' ') AS s
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 8, 2))) AS i FROM b WHERE len(words) > 0)
), sizes AS (SELECT DISTINCT k FROM x), p AS (
  SELECT doc_id, k, i, array_to_string(words[i:i + k - 1], ' ') AS s
  FROM (SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM w, sizes WHERE len(words) >= k)
), m AS (
  SELECT p.doc_id, p.i, p.k, x.item_id FROM p JOIN x ON x.k = p.k AND x.s = p.s
), hit AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM m) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM m) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(named.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM w LEFT JOIN hit ON hit.doc_id = w.doc_id LEFT JOIN named ON named.doc_id = w.doc_id
"""
}
