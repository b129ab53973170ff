"""Quality classifier by importance resampling: hashed n-gram generative models of the target and of the raw text give each
document an importance, and Gumbel top-k samples by it.

A document is a bag of n-grams of words and of forms of words (capitals, marks, repeats), hashed to a fixed number of buckets of
each kind. Its importance is the log ratio of its chances under the two models, the sum of its n-grams' log ratios.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, small_batches, table
from .shingles import SPACES, shapes, text_slices, windows, words

BUCKETS = 10_000
#: n-grams of words, and of forms.
ORDERS = ((1, 2), (1, 2, 3))
#: Labelled documents that target model and threshold are fitted on, at most: those least by a hash of doc_id.
LABELLED = 20_000
#: What importances are divided by before Gumbel noise of scale 1 is added.
TEMPERATURE = 1.0
SEED = 17
#: Bytes of text that are scored at a time: n-grams of five orders are held for each word.
SLICE = 1 << 18


def _features(texts: pa.Array, buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text) of the n-grams of each stream; the streams' buckets follow each other."""
    w = words(texts, SPACES)
    plain = words(texts, SPACES, lower=True).hashes()
    out = []
    for s, (stream, orders) in enumerate(zip((plain, shapes(w, plain)), ORDERS, strict=True)):
        each = [windows(stream, w.first, k, seed=k)[:2] for k in orders]
        out.append((np.concatenate([h % np.uint64(buckets) for h, _ in each]).astype(np.int64) + s * buckets, np.concatenate([t for _, t in each])))
    return out


def _counts(buckets: int):
    """Of a task's texts: n-grams by bucket, all and those of target texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(2 * buckets, np.int64), np.zeros(2 * buckets, np.int64)
        for batch in batches:
            good = batch.column("good").to_numpy(zero_copy_only=False) == 1
            for a, b in text_slices(batch, most=SLICE):
                for bucket, text in _features(batch.column("text").slice(a, b - a), buckets):
                    raw += np.bincount(bucket, minlength=2 * buckets)
                    target += np.bincount(bucket[good[a:b][text]], minlength=2 * buckets)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], ["bucket", "raw", "target"])

    return run


def _scores(ratio, buckets: int, whole: bool = False):
    """Add n_features and importance to rows. whole: the texts stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log = ratio.value
        for batch in batches:
            for a, b in text_slices(batch, most=SLICE):
                part = batch.slice(a, b - a)
                score, n = np.zeros(b - a), np.zeros(b - a, np.int64)
                for bucket, text in _features(part.column("text"), buckets):
                    score += np.bincount(text, weights=log[bucket], minlength=b - a)
                    n += np.bincount(text, minlength=b - a)
                cols = {c: part.column(c) for c in part.schema.names if whole or c != "text"}
                yield pa.RecordBatch.from_arrays([*cols.values(), pa.array(n), pa.array(score)], [*cols, "n_features", "importance"])

    return run


@dataclass
class Model:
    """Log ratios by bucket, and the threshold between importances of bad and good documents."""

    ratio: np.ndarray
    threshold: float


def labelled_sample(labels: DataFrame, most: int) -> DataFrame:
    """(id, good) of at most `most` labelled documents, chosen by a hash of doc_id; a document with any bad label is bad."""
    return labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(F.min("quality").alias("good")).orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(most)


def threshold_of(bad: np.ndarray, good: np.ndarray) -> float:
    """The cut with the least error rate of both classes together, in the middle of the gap there."""
    if not len(bad) or not len(good):
        return -np.inf
    cuts = np.unique(np.concatenate([bad, good]))
    wrong = (1 - np.searchsorted(np.sort(bad), cuts, "left") / len(bad)) + np.searchsorted(np.sort(good), cuts, "left") / len(good)
    best = int(wrong.argmin())
    below = bad[bad < cuts[best]]
    return float((cuts[best] + below.max()) / 2 if len(below) else cuts[best])


def fit(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, labelled: int = LABELLED) -> Model:
    """The raw model is counted over all documents, the target model over the good ones of a bounded labelled sample."""
    spark = docs.sparkSession
    sample = saved(labelled_sample(labels, labelled), "quality_sample")
    # a sample of at most `labelled` rows of 12 bytes is sent to all tasks
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("id"), "left").select("text", "good")
    counted = rows.mapInArrow(_counts(buckets), "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect()  # two rows of numbers for each bucket
    raw, target = np.zeros(2 * buckets), np.zeros(2 * buckets)
    for b, r, t in counted:
        raw[b], target[b] = r, t
    share = lambda x: np.concatenate([(y + 1) / (y.sum() + buckets) for y in np.split(x, 2)])
    ratio = np.log(share(target) / share(raw))
    seen = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("id")).select("good", "text")
    known = np.array([(r["good"], r["importance"]) for r in seen.mapInArrow(_scores(spark.sparkContext.broadcast(ratio), buckets), "good int, n_features long, importance double").groupBy("good", "importance").agg(F.count("*")).collect()]).reshape(-1, 2)  # at most as many as the sample, but for ids with several texts
    return Model(ratio, threshold_of(known[known[:, 0] == 0, 1], known[known[:, 0] == 1, 1]))


def _perturbed(scored: DataFrame, temperature: float, seed: int) -> DataFrame:
    """Adds weight and perturbed to rows with importance and draw, a hash of the row."""
    chance = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "draw"), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return scored.withColumn("weight", F.col("importance") / F.lit(temperature)).withColumn("perturbed", F.col("weight") - F.log(-F.log(chance)))


def _wanted(scored: DataFrame, model: Model, keep: float | None) -> int:
    """k: a number of documents, or a share of all; without it as many as have an importance over the threshold."""
    if keep is None:
        return scored.where(F.col("importance") >= F.lit(model.threshold)).count()
    return int(keep) if keep > 1 else round(keep * scored.count())


def _sampled(docs: DataFrame, labels: DataFrame, buckets: int, labelled: int, keep: float | None, temperature: float, seed: int) -> tuple[Model, object, DataFrame, float]:
    """The model, its ratios as a broadcast, all scores, and the perturbed importance of the last document that is sampled."""
    spark = docs.sparkSession
    small_batches(spark)
    model = fit(docs, labels, buckets, labelled)
    ratio = spark.sparkContext.broadcast(model.ratio)
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("draw"), "text")
    scored = rows.mapInArrow(_scores(ratio, buckets), "doc_id long, draw long, n_features long, importance double")
    scored = saved(_perturbed(scored, temperature, seed), "quality_scores")
    return model, ratio, scored, kth_largest(scored, "perturbed", _wanted(scored, model, keep))


def classify(docs: DataFrame, labels: DataFrame, keep: float | None = None, buckets: int = BUCKETS, labelled: int = LABELLED, temperature: float = TEMPERATURE, seed: int = SEED) -> DataFrame:
    """Sample k documents without replacement, each with a chance in proportion to the ratio of the models: the k largest of
    importance / temperature + Gumbel noise, which is drawn from a hash of doc_id and text.

    keep is k, or if it is 1 or less its share of all documents. Without it k is the number of documents that are over the
    threshold between labelled bad and good ones, so that as many are kept as look good. Returns doc_id, n_features, importance,
    weight (importance / temperature), perturbed, over_threshold and selected, one row for each input row. Documents tied at the
    cut all stay, so that rows with one doc_id and text come or go together. A text without words, empty or null, has importance
    0. Rows without doc_id are sampled like others. Without labels of both classes everything is over the threshold.
    """
    model, _, scored, cut = _sampled(docs, labels, buckets, labelled, keep, temperature, seed)
    return scored.drop("draw").withColumns({"over_threshold": F.col("importance") >= F.lit(model.threshold), "selected": F.col("perturbed") >= F.lit(cut)})


def select_documents(docs: DataFrame, labels: DataFrame, keep: float | None = None, buckets: int = BUCKETS, labelled: int = LABELLED, temperature: float = TEMPERATURE, seed: int = SEED) -> DataFrame:
    """The rows of docs that classify() selects. Texts are scored once more rather than shuffled to meet their scores."""
    _, ratio, _, cut = _sampled(docs, labels, buckets, labelled, keep, temperature, seed)
    names = {c: f"_doc_{c}" for c in docs.columns if c not in ("doc_id", "text")}
    rows = docs.withColumnsRenamed(names).withColumn("draw", F.xxhash64("doc_id", "text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), "n_features long", "importance double"])
    scored = _perturbed(rows.mapInArrow(_scores(ratio, buckets, whole=True), schema), temperature, seed)
    added = ("draw", "n_features", "importance", "weight", "perturbed")
    return scored.where(F.col("perturbed") >= F.lit(cut)).drop(*added).withColumnsRenamed({v: k for k, v in names.items()}).select(*docs.columns)


def kth_largest(rows: DataFrame, column: str, k: int, bins: int = 1 << 12) -> float:
    """The k-th largest value, exactly: the range that holds it is cut into bins until all its values are the same. Each pass
    returns one row for each bin."""
    if k <= 0:
        return float("inf")
    low, high = rows.agg(F.min(column), F.max(column)).first()
    while low < high:
        width = (high - low) / bins
        if not width or low + width == low:
            break
        bin_ = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
        seen = sorted(rows.where(F.col(column).between(low, high)).groupBy(bin_.alias("bin")).agg(F.count("*"), F.min(column), F.max(column)).collect(), reverse=True)
        for _, n, least, most in seen:
            if k <= n:
                low, high = least, most
                break
            k -= n
        else:
            return low
    return low


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
