"""Collocations: frequent phrases by vertical positional lists, scored by how much more often they stand than their parts would.

Texts of one language are packed into slices, in which each word occurrence has a position. A phrase's occurrences are a list of
positions, sorted; the list of a longer phrase is made by joining the positions after a frequent phrase's occurrences with the
postings of frequent words, so that the lengths of its lists are its exact frequency. After each length a slice sends its phrases
once, with their lists' lengths, to the phrases' buckets, and gets their ids back, or that they are too rare; rare ones are not
extended, since nothing longer can be frequent. Words go as words; phrases as the ids of their first words and of their last one, so
nothing is known by a hash.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import forget, parts_for, saved, small_batches, table, text_bytes
from .shingles import Words, by_bucket, distinct, give_back, mix, text_slices, words

LONGEST, LEAST, TOP = 5, 100, 2000
#: Bytes of text in one slice, and bytes of text whose slices' phrases meet in one bucket.
SLICE, BUCKET = 2 << 20, 8 << 20
#: Parts into which a language's phrases are dealt before its best are chosen.
SALTS = 64

_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BREAKS = _ENDS.copy()
_BREAKS[[0x20, 0x09]] = True
_WORDS_ROW = "slice long, lang string, n_words long, words binary, sizes binary, counts binary, places binary"


def _packed(texts: list[pa.Array], lang: str, number: int) -> pa.RecordBatch:
    """A slice: its distinct words with their counts, and the word at each place; -1 stands between pieces."""
    w = words(pa.concat_arrays([x.cast(pa.large_string()) for x in texts]), _BREAKS, lower=True)
    d, which = distinct(w)
    ends = np.r_[0, np.cumsum(_ENDS[w.data], dtype=np.int64)]
    new = np.r_[False, ends[w.start[1:]] != ends[w.end[:-1]]] if len(w.start) else np.zeros(0, bool)
    new[w.first[(w.first > 0) & (w.first < len(w.start))]] = True
    places = np.full(len(which) + int(new.sum()), -1, "<i4")
    places[np.arange(len(which)) + np.cumsum(new)] = which
    size = d.end - d.start
    data = b"".join(d.data[x:y].tobytes() for x, y in zip(d.start.tolist(), d.end.tolist(), strict=True))
    task = TaskContext.get()
    uid = (task.partitionId() if task else 0) << 32 | number
    row = [data, size.astype("<u4").tobytes(), np.bincount(which, minlength=len(size)).astype("<u4").tobytes(), places.tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([uid]), pa.array([lang]), pa.array([len(which)]), *(pa.array([x], pa.binary()) for x in row)], _WORDS_ROW.replace(",", "").split()[::2])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[pa.Array]] = {}
    size: dict[str, int] = {}
    number = 0
    for batch in batches:
        for a, b in text_slices(batch):
            part = batch.slice(a, b - a)
            part = part.filter(pc.greater(pc.fill_null(pc.binary_length(part.column("text")), 0), 0))
            for lang in pc.unique(part.column("lang")).to_pylist():
                texts = part.column("text").filter(pc.equal(part.column("lang"), lang))
                held.setdefault(lang, []).append(texts)
                size[lang] = size.get(lang, 0) + pc.sum(pc.binary_length(texts)).as_py()
            full = list(held) if sum(size.values()) > 4 * SLICE else [x for x in held if size[x] >= SLICE]
            for lang in full:
                yield _packed(held.pop(lang), lang, number)
                number += 1
                del size[lang]
    for lang, texts in held.items():
        yield _packed(texts, lang, number)
        number += 1


def _split(raw: pa.Buffer, sizes: pa.Buffer) -> pa.Array:
    """Words that were joined."""
    cuts = np.r_[0, np.cumsum(np.frombuffer(sizes, "<u4"), dtype=np.int64)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), raw])


_ASKED_WORDS = "lang string, bucket int, slice long, words binary, sizes binary, counts binary"
#: Rows of an answer: ids to a slice (kind 0), or a frequent phrase (kind 1).
_ANSWER = "kind int, slice long, bucket int, ids binary, lang string, id long, word string, prefix long, last long, f long"
_REPLIES, _FOUND = 0, 1


def _word_buckets(row: dict, buckets: int) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """A slice's distinct words, and their order by bucket."""
    to = np.cumsum(np.frombuffer(row["sizes"], "<u4"), dtype=np.int64)
    w = Words(np.frombuffer(row["words"], np.uint8), np.r_[0, to][:-1], to, np.array([0, len(to)]))
    return w, *by_bucket((w.hashes() >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32))


def _ask_words(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                w, order, held, cuts = _word_buckets(row, buckets)
                size, count = (w.end - w.start)[order].astype("<u4"), np.frombuffer(row["counts"], "<u4")[order]
                raw = [w.data[x:y].tobytes() for x, y in zip(w.start[order].tolist(), w.end[order].tolist(), strict=True)]
                parts = list(itertools.pairwise(cuts.tolist())) if len(order) else []
                cols = [[b"".join(raw[i:j]) for i, j in parts], [size[i:j].tobytes() for i, j in parts], [count[i:j].tobytes() for i, j in parts]]
                yield pa.RecordBatch.from_arrays([pa.array([row["lang"]] * len(parts), pa.string()), pa.array(held.astype(np.int32)), pa.array([row["slice"]] * len(parts), pa.int64()), *(pa.array(x, pa.binary()) for x in cols)], _ASKED_WORDS.replace(",", "").split()[::2])

    return run


def _answers(key: tuple[pa.Scalar, ...], t: pa.Table, which: np.ndarray, counts: np.ndarray, cuts: np.ndarray, n: int, least: int) -> tuple[pa.Table, np.ndarray, dict]:
    """Ids to each slice, numbered within the bucket; which keys are frequent; and the columns that all frequent phrases have."""
    f = np.bincount(which, counts, n).astype(np.int64)
    found = np.flatnonzero(f >= least)
    ids = np.zeros(n, "<i8")
    ids[found] = (key[1].as_py() << 32) + 1 + np.arange(len(found))
    flat = ids[which]
    reply = pa.table({"kind": pa.array([_REPLIES] * t.num_rows, pa.int32()), "slice": t.column("slice"), "bucket": t.column("bucket"), "ids": pa.array([flat[i:j].tobytes() for i, j in itertools.pairwise(cuts.tolist())], pa.binary())})
    return reply, found, {"kind": pa.array([_FOUND] * len(found), pa.int32()), "lang": pa.array([key[0].as_py()] * len(found), pa.string()), "id": pa.array(ids[found]), "f": pa.array(f[found])}


def _whole(*parts: pa.Table) -> pa.Table:
    """Tables with the columns of an answer, nulls where they have none."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    return pa.concat_tables([pa.table({name: (p.column(name).cast(kinds[kind]) if name in p.column_names else pa.nulls(p.num_rows, kinds[kind])) for name, kind in (x.split() for x in _ANSWER.split(", "))}) for p in parts])


def _count_words(least: int):
    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        give_back()
        own = [_split(x.as_buffer(), y.as_buffer()) for x, y in zip(t.column("words"), t.column("sizes"), strict=True)]
        both = pa.concat_arrays(own).dictionary_encode()
        counts = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in t.column("counts")])
        reply, found, columns = _answers(key, t, both.indices.to_numpy(), counts, np.r_[0, np.cumsum([len(x) for x in own])], len(both.dictionary), least)
        return _whole(reply, pa.table(columns | {"word": both.dictionary.take(pa.array(found)).cast(pa.large_string())}))

    return run


_STATE = "slice long, lang string, word_ids binary, places binary, phrase_ids binary, at binary, phrase binary"


def _first_state(buckets: int):
    """Of a slice and its words' ids: the frequent words at their places, which are phrases of one word."""

    def run(_: tuple[pa.Scalar, ...], slices: pa.Table, replies: pa.Table) -> pa.Table:
        out = []
        for row in slices.to_pylist():
            _w, order, _held, _cuts = _word_buckets(row, buckets)
            ids = np.zeros(len(order), np.int64)
            ids[order] = _joined_ids(replies)
            number = np.cumsum(ids > 0) - 1
            places = np.frombuffer(row["places"], "<i4")
            places = np.where((places >= 0) & (ids > 0)[places], number[places], -1) if len(ids) else places
            at = np.flatnonzero(places >= 0)
            out.append((row["slice"], row["lang"], ids[ids > 0], places, ids[ids > 0], *_vertical(at, places[at])))
        return _states(out)

    return run


def _joined_ids(replies: pa.Table) -> np.ndarray:
    return np.concatenate([np.zeros(0, "<i8"), *(np.frombuffer(x.as_buffer(), "<i8") for x in replies.sort_by("bucket").column("ids"))])


def _vertical(at: np.ndarray, phrase: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists of positions, one phrase after the other."""
    order = np.argsort(phrase, kind="stable")
    return at[order], phrase[order]


def _states(rows: list[tuple]) -> pa.Table:
    kinds = ["<i8", "<i4", "<i8", "<i4", "<i4"]
    cols = list(zip(*rows, strict=True)) or [[]] * 7
    binary = [pa.array([np.asarray(x).astype(kind).tobytes() for x in col], pa.binary()) for col, kind in zip(cols[2:], kinds, strict=True)]
    return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), *binary], _STATE.replace(",", "").split()[::2])


class _Extension:
    """The lists of a slice's phrases of k words, from those of k - 1 words."""

    def __init__(self, row: dict, k: int):
        of = lambda name, kind: np.frombuffer(row[name], kind)
        self.word_ids, self.places, phrase_ids = of("word_ids", "<i8"), of("places", "<i4"), of("phrase_ids", "<i8")
        at, phrase = of("at", "<i4").astype(np.int64), of("phrase", "<i4").astype(np.int64)
        starts = np.zeros(len(self.places) + 1, bool)
        starts[at] = True
        inside = at + k - 1 < len(self.places)
        at, phrase = at[inside], phrase[inside]
        word = self.places[at + k - 1].astype(np.int64)  # the postings of frequent words, read at the place behind each occurrence
        open_ = (word >= 0) & starts[at + 1]  # the words behind the first have to be frequent together, too
        self.at, key = at[open_], phrase[open_] * max(1, len(self.word_ids)) + word[open_]
        held, self.which, self.count = np.unique(key, return_inverse=True, return_counts=True)
        self.prefix, self.last = phrase_ids[held // max(1, len(self.word_ids))], self.word_ids[held % max(1, len(self.word_ids))]

    def by_bucket(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mixed = mix(mix(self.prefix.view(np.uint64)) + self.last.view(np.uint64))
        return by_bucket((mixed >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32))


_ASKED = "lang string, bucket int, slice long, prefix binary, last binary, counts binary"


def _ask(k: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x = _Extension(row, k)
                order, held, cuts = x.by_bucket(buckets)
                parts = list(itertools.pairwise(cuts.tolist())) if len(order) else []
                cols = [[v[i:j].tobytes() for i, j in parts] for v in (x.prefix[order], x.last[order], x.count[order].astype("<u4"))]
                yield pa.RecordBatch.from_arrays([pa.array([row["lang"]] * len(parts), pa.string()), pa.array(held.astype(np.int32)), pa.array([row["slice"]] * len(parts), pa.int64()), *(pa.array(c, pa.binary()) for c in cols)], _ASKED.replace(",", "").split()[::2])

    return run


def _count(least: int):
    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        give_back()
        prefix, last = (np.concatenate([np.frombuffer(x.as_buffer(), "<i8") for x in t.column(c)]) for c in ("prefix", "last"))
        counts = [np.frombuffer(x.as_buffer(), "<u4") for x in t.column("counts")]
        order = np.lexsort((last, prefix))
        new = np.r_[True, (prefix[order][1:] != prefix[order][:-1]) | (last[order][1:] != last[order][:-1])]
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        reply, found, columns = _answers(key, t, which, np.concatenate(counts), np.r_[0, np.cumsum([len(x) for x in counts])], int(new.sum()), least)
        one = order[new][found]
        return _whole(reply, pa.table(columns | {"prefix": prefix[one], "last": last[one]}))

    return run


def _next_state(k: int, buckets: int):
    def run(_: tuple[pa.Scalar, ...], states: pa.Table, replies: pa.Table) -> pa.Table:
        out = []
        for row in states.to_pylist():
            x = _Extension(row, k)
            ids = np.zeros(len(x.prefix), np.int64)
            ids[x.by_bucket(buckets)[0]] = _joined_ids(replies)
            keep = ids[x.which] > 0 if len(ids) else np.zeros(0, bool)
            number = np.cumsum(ids > 0) - 1
            at, phrase = x.at[keep], number[x.which[keep]]
            out.append((row["slice"], row["lang"], x.word_ids, x.places, ids[ids > 0], *_vertical(at, phrase)))
        return _states(out)

    return run


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, f) of all phrases of up to `longest` words that occur `least` times or more in a language, and (lang, n) of
    all words."""
    spark = docs.sparkSession
    small_batches(spark)
    buckets = parts_for(spark, text_bytes(docs), BUCKET)
    own = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    slices = saved(own.mapInArrow(_slices, _WORDS_ROW), "phrases_slices")
    total = saved(slices.groupBy("lang").agg(F.sum("n_words").alias("n")), "phrases_total")
    asked = slices.select("slice", "lang", "words", "sizes", "counts").mapInArrow(_ask_words(buckets), _ASKED_WORDS)
    answer = saved(asked.groupBy("lang", "bucket").applyInArrow(_count_words(least), _ANSWER), "phrases_answers")
    replies = lambda: answer.where(f"kind = {_REPLIES}").select("slice", "bucket", "ids").groupBy("slice")
    found = [saved(answer.where(f"kind = {_FOUND}").select("lang", "id", F.col("word").alias("phrase"), "f"), "phrases_1")]
    state = saved(slices.groupBy("slice").cogroup(replies()).applyInArrow(_first_state(buckets), _STATE), "phrases_state")
    forget(slices, answer)
    for k in range(2, longest + 1):
        answer = saved(state.mapInArrow(_ask(k, buckets), _ASKED).groupBy("lang", "bucket").applyInArrow(_count(least), _ANSWER), "phrases_answers")
        pairs = answer.where(f"kind = {_FOUND}").select("lang", "id", "prefix", "last", "f")
        first, last = found[-1].select("lang", F.col("id").alias("prefix"), F.col("phrase").alias("first")), found[0].select("lang", F.col("id").alias("last"), F.col("phrase").alias("word"))
        both = pairs.join(first, ["lang", "prefix"]).join(last, ["lang", "last"])
        found.append(saved(both.select("lang", "id", F.concat_ws(" ", "first", "word").alias("phrase"), "f"), f"phrases_{k}"))
        if k < longest:
            before, state = state, saved(state.groupBy("slice").cogroup(replies()).applyInArrow(_next_state(k, buckets), _STATE), "phrases_state")
            forget(before)
        forget(answer)
    forget(state)
    out = [df.select("lang", "phrase", F.lit(k).alias("k"), "f") for k, df in enumerate(found, 1)]
    whole = saved(functools.reduce(DataFrame.unionByName, out), "phrases_all")
    forget(*found)
    return whole, total


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's `top` phrases of two to `longest` words.

    A-Z count as a-z. Texts end pieces at `.,;:!?` and line breaks (U+000A to U+000D); words are what stands between spaces and tabs in a
    piece. Phrases are words that follow each other in a piece, and count wherever they stand (a), overlaps included; those that occur
    fewer than `least` times are none. n is the number of the language's words. Of the ways to cut a phrase in two, that with the
    least floor(1000 * a * n / (l * r)) is its score, with l and r the parts' frequencies; of equal ones the first. Phrases that
    stand inside a longer one of the same frequency don't count. Order: score and a descending, then the phrase's bytes. A null lang
    is `und`; a null or empty text has no words; rows and their ids may repeat, each row counts. Other columns are left out.
    """
    known, total = frequent_phrases(docs, longest, least)
    long = known.where("k >= 2").withColumn("words", F.split("phrase", " "))
    part = lambda a, n: F.concat_ws(" ", F.slice("words", a, n))
    inner = long.where("k >= 3").select("lang", F.explode(F.array(part(F.lit(1), F.col("k") - 1), part(F.lit(2), F.col("k") - 1))).alias("phrase"), "f")
    inner = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = long.join(inner, ["lang", "phrase"], "left").where("longer IS NULL OR longer < f")
    cuts = kept.select("lang", "phrase", "k", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("first"), part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
    f = known.select("lang", "phrase", "f")
    cuts = cuts.join(f.toDF("lang", "first", "l"), ["lang", "first"]).join(f.toDF("lang", "rest", "r"), ["lang", "rest"]).join(total, "lang")
    wide = lambda c: F.col(c).cast("decimal(20,0)")  # noqa: E731  # products of up to 38 digits
    cuts = cuts.withColumns({"over": (F.col("a") * 1000).cast("decimal(18,0)") * wide("n"), "under": wide("l") * wide("r")}).withColumn("score", F.expr("over div under"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("m")).select("lang", "phrase", "a", "n", "m.l", "m.r", "m.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt")
    few = best.select("*", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    out = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = {
    "op13_phrase_collocations": """
WITH w AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)
), f AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS a FROM (
    SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(ws) >= k)
  GROUP BY ALL
), n AS (
  SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), c AS (
  SELECT lang, k, phrase, a FROM f WHERE k >= 2 AND a >= 100
), s AS (
  SELECT x.lang, x.phrase, x.a, n.n, x.j, p.a AS l, q.a AS r, (1000::HUGEINT * x.a * n.n) // (p.a::HUGEINT * q.a) AS score
  FROM (SELECT lang, phrase, a, k, string_split(phrase, ' ') AS ws, unnest(range(1, k)) AS j FROM c) x
  JOIN f p ON p.lang = x.lang AND p.phrase = array_to_string(x.ws[1:x.j], ' ')
  JOIN f q ON q.lang = x.lang AND q.phrase = array_to_string(x.ws[x.j + 1:], ' ')
  JOIN n ON n.lang = x.lang
), b AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), g AS (
  SELECT DISTINCT i.lang, i.phrase FROM c i JOIN c o
  ON o.lang = i.lang AND o.k > i.k AND contains(' ' || o.phrase || ' ', ' ' || i.phrase || ' ') AND 100 * o.a >= 100 * i.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM b ANTI JOIN g USING (lang, phrase) QUALIFY rank <= 2000
"""
}
