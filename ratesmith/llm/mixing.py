"""Mixing sources to target weights: temperature mixing, realised as budgeted block permutations.

A source's weight is its token share to the power of an exponent between 0 (all sources alike) and 1 (as they are). The exponent
is searched between bounds until the weights meet a target entropy, or until no source is repeated more often than allowed. A
source then gives whole permutations of its documents (blocks), and of one more block as many documents as its budget still holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved, small_batches, table
from .shingles import text_slices, words

MAX_REPEATS = 2.0
SEED = 23
#: Exponents that one pass over the sources tries, and passes: each cuts the interval to a part.
TRIES, PASSES = 32, 6
_BITS, _LEVELS = 12, 2


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in text_slices(batch):
            part = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays([part.column("source"), part.column("key"), pa.array(words(part.column("text")).counts())], ["source", "key", "n_tokens"])


def _key(seed: int) -> Column:
    """Where a document stands in its source's permutation: equal rows stand together."""
    return F.xxhash64(F.lit(seed), "doc_id", "text")


def _entropy(z: Column, zlog: Column, alpha: float) -> Column:
    return F.log(z) - F.lit(alpha) * zlog / z


def exponent(sources: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None, budget: float | None = None) -> float:
    """The smallest exponent (so, the evenest mix) that repeats no source more than max_repeats times, or the one whose weights
    have the target entropy (in nats). Both measures fall or rise with the exponent, and each pass tries TRIES exponents at once.

    sources: (source, tokens), tokens over 0. Without a budget the budget is the least that holds every document once.
    """
    total, least, most = sources.agg(F.sum("tokens").cast("double"), F.min("tokens").cast("double"), F.max("tokens").cast("double")).first()
    if not total:
        return 1.0
    p = F.col("tokens") / F.lit(total)
    low, high = 0.0, 1.0
    for _ in range(PASSES):
        tries = [low + (high - low) * i / TRIES for i in range(TRIES + 1)]
        power = lambda a: F.pow(p, F.lit(a))
        sums = sources.agg(*(F.struct(F.sum(power(a)).alias("z"), F.sum(power(a) * F.log(p)).alias("zlog")).alias(f"t{i}") for i, a in enumerate(tries))).select(
            *(F.struct(F.col(f"t{i}.z"), _entropy(F.col(f"t{i}.z"), F.col(f"t{i}.zlog"), a).alias("h")).alias(f"t{i}") for i, a in enumerate(tries))).first()

        def enough(i: int, a: float, sums=sums) -> bool:
            if target_entropy is not None:
                return sums[i]["h"] <= target_entropy
            whole = budget if budget is not None else total * sums[i]["z"] * (most / total) ** (1 - a)
            return (least / total) ** (a - 1) / sums[i]["z"] * whole / total <= max_repeats

        first = next((i for i, a in enumerate(tries) if enough(i, a)), TRIES)
        if first == 0:
            return low
        low, high = tries[first - 1], tries[first]
    return high


def plan(docs: DataFrame, target_entropy: float | None = None, max_repeats: float | None = MAX_REPEATS, budget: float | None = None, seed: int = SEED) -> DataFrame:
    """(source, tokens, weight, blocks, cut): whole blocks of each source, and the key up to which the next block goes (null: none of it)."""
    small_batches(docs.sparkSession)
    rows = saved(docs.select("source", _key(seed).alias("key"), "text").mapInArrow(_tokens, "source string, key long, n_tokens long"), "mixing_tokens")
    sources = saved(rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "mixing_sources")
    real = sources.where("tokens > 0")
    alpha = exponent(real, target_entropy, None if target_entropy is not None else max_repeats, budget)
    power = F.pow("tokens", F.lit(alpha))
    norm, need = real.agg(F.sum(power), F.max(F.col("tokens") / power)).first()
    whole = budget if budget is not None else (norm or 0.0) * (need or 0.0)
    real = real.withColumn("weight", power / F.lit(norm))
    quota = F.col("weight") * F.lit(float(whole))
    real = real.withColumns({"blocks": F.floor(quota / F.col("tokens") + F.lit(1e-9)).cast("int")}).withColumn("left", F.greatest(quota - F.col("blocks") * F.col("tokens"), F.lit(0.0)))
    # the part of a block: bins of the key are summed, the bin in which the budget ends is cut into finer ones, and the last is read in order
    keyed = real.select(F.col("source").alias("of"), "left", F.lit(0).cast("long").alias("from"), F.lit(0.0).alias("before"))
    same = F.col("source").eqNullSafe(F.col("of"))
    place = F.shiftrightunsigned(F.col("key"), 1)
    for level in range(_LEVELS):
        shift = 63 - _BITS * (level + 1)
        inside = F.shiftrightunsigned(place, shift + _BITS) == F.col("from")
        bins = rows.join(keyed, same).where(inside).groupBy("of", "left", "before", F.shiftrightunsigned(place, shift).alias("bin")).agg(F.sum("n_tokens").alias("n"))
        up = Window.partitionBy("of").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        over = bins.withColumn("until", F.col("before") + F.sum("n").over(up)).where(F.col("until") > F.col("left") * (1 + 1e-12))
        keyed = saved(over.groupBy("of", "left").agg(F.min("bin").alias("from"), F.min_by(F.col("until") - F.col("n"), "bin").alias("before")), "mixing_bins")
    last = rows.join(keyed, same).where(F.shiftrightunsigned(place, shift) == F.col("from"))
    order = Window.partitionBy("of").orderBy(place).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    fits = last.withColumn("until", F.col("before") + F.sum("n_tokens").over(order)).where(F.col("until") <= F.col("left")).groupBy("of").agg(F.max(place).alias("in"))
    begin = F.shiftleft(F.col("from"), shift) - 1  # all of the bins before
    cuts = keyed.select("of", begin.alias("begin")).join(fits.withColumnRenamed("of", "fit"), F.col("of").eqNullSafe(F.col("fit")), "left").select("of", F.coalesce("in", "begin").alias("cut"))
    # a source without tokens costs nothing and comes once
    out = sources.select("source", "tokens").join(real.select(F.col("source").alias("real"), "weight", "blocks"), F.col("source").eqNullSafe(F.col("real")), "left")
    out = out.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left")
    return saved(out.select("source", "tokens", F.coalesce("weight", F.lit(0.0)).alias("weight"), F.coalesce("blocks", F.lit(1)).alias("blocks"), "cut"), "mixing_plan")


def mix(docs: DataFrame, target_entropy: float | None = None, max_repeats: float | None = MAX_REPEATS, budget: float | None = None, seed: int = SEED) -> DataFrame:
    """Repeat each document as often as its source's budget says: the columns of docs, with weight (of the source), block and
    place, one row for each time. (block, place) is the order of a source's documents in its permutations.

    Tokens are words. Rows with equal doc_id and text stand at one place of a block and come or go together. Null is a source like
    others. A text without words costs nothing: it comes in each of its source's blocks, once where the source has no words at
    all. Columns of docs with the names weight, block and place are replaced.
    """
    chosen = plan(docs, target_entropy, max_repeats, budget, seed).select(F.col("source").alias("_of"), F.col("weight").alias("_weight"), F.col("blocks").alias("_blocks"), F.col("cut").alias("_cut"))
    docs = docs.drop("weight", "block", "place")
    place = F.shiftrightunsigned(_key(seed), 1)
    times = F.col("_blocks") + F.when(place <= F.col("_cut"), 1).otherwise(0)
    rows = docs.join(chosen, F.col("source").eqNullSafe(F.col("_of"))).withColumn("_times", times).where("_times > 0")
    out = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("_times") - 1)))
    # the last block is a part of the permutation by place; whole blocks are permutations of their own
    return out.withColumns({"weight": F.col("_weight"), "place": F.when(F.col("block") < F.col("_blocks"), F.xxhash64(F.lit(seed), "block", place)).otherwise(place)}).drop("_of", "_weight", "_blocks", "_cut", "_times")


def op5_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select("doc_id", "source", "weight", "block", "place")
