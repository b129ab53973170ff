"""Exact top-k inner product search in norm buckets.

Vectors are sorted by length and cut into buckets, runs of buckets are groups; queries are cut into blocks. A first pass over the
group of the longest vectors gives each query a score that its k-th best has at least. With it a bucket has a local threshold for
each query: the cosine that a vector of the bucket's greatest length needs. Groups in which it is over 1 for all queries of a block
aren't sent the block, buckets aren't opened. Where it is high, the query's strongest coordinates bound what its partners'
coordinates can be; elsewhere only vectors that are long enough are taken. What is left is verified by its exact product.

A task has one group and some blocks of queries, goes through its buckets from the longest on, and keeps k results of each query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved, small_batches, table

SCALE, TOP, QUERY_EACH = 256, 5, 50
BUCKET, BLOCK = 2048, 1024
#: Buckets in a group, and blocks of queries that meet a group in one task.
GROUP_BUCKETS, TASK_BLOCKS = 16, 8
#: Components up to this are kept as 32-bit integers; buckets with larger ones hold doubles, which are whole numbers too.
NARROW = float(1 << 31)
#: From this local cosine on, coordinates prune.
COORDINATE_COSINE = 0.8
FOCUS = 4
_PACK = "dim int, n int, longest double, kind string, ids binary, matrix binary, norms binary"


def _integers(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors, dims, norms = [], [], [], []
            for i, x in zip(batch.column("vec_id").to_pylist(), batch.column("embedding"), strict=True):
                v = None if not x.is_valid or i is None else x.values
                if v is None or v.null_count or not len(v):
                    continue
                v = v.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(v).all():
                    with np.errstate(over="ignore"):
                        v = np.clip(np.floor(scale * v), -np.finfo(np.float64).max, np.finfo(np.float64).max)
                    most = float(np.abs(v).max())
                    ids.append(i)
                    dims.append(len(v))
                    vectors.append(v.astype("<i4" if most < NARROW else "<f8").tobytes())
                    norms.append(float(most * np.sqrt(((v / most) ** 2).sum())) if most else 0.0)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(norms, pa.float64()), pa.array(vectors, pa.binary())], ["vec_id", "dim", "norm", "vector"])

    return run


def _packed(most: int):
    """Runs of rows of one dimension as matrices of at most `most` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def pack(t: pa.Table) -> pa.RecordBatch:
            norms = t.column("norm").to_numpy()
            dim, vectors = t.column("dim")[0].as_py(), t.column("vector").to_pylist()
            kind = "<i4" if all(len(x) == 4 * dim for x in vectors) else "<f8"
            matrix = b"".join(x if kind == "<i4" or len(x) == 8 * dim else np.frombuffer(x, "<i4").astype("<f8").tobytes() for x in vectors)
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([len(t)], pa.int32()), pa.array([float(norms.max())]), pa.array([kind]), *(pa.array([x], pa.binary()) for x in (t.column("vec_id").to_numpy().tobytes(), matrix, norms.tobytes()))], ["dim", "n", "longest", "kind", "ids", "matrix", "norms"])

        def flush(whole: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            t = pa.Table.from_batches(held).combine_chunks()
            while t.num_rows:
                dims = t.column("dim").to_numpy()
                n = int(min(most, np.r_[np.flatnonzero(dims != dims[0]), len(dims)][0]))
                if n == len(dims) and n < most and not whole:
                    break
                yield pack(t.slice(0, n))
                t = t.slice(n)
            held = t.to_batches()

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= most:
                yield from flush(False)
        if held:
            yield from flush(True)

    return run


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], "<i8")
    return ids, np.frombuffer(row["matrix"], row["kind"]).reshape(len(ids), -1), np.frombuffer(row["norms"], "<f8")


_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def _products(a: np.ndarray, b: np.ndarray, longest: float) -> np.ndarray:
    """Exact inner products, none of which is over `longest`: whole numbers below 2**53 are exact as doubles. Products that a long
    can't hold become the least or the largest long."""
    if longest < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if longest < 1 << 62 and a.dtype.kind == b.dtype.kind == "i":
        return a.astype(np.int64) @ b.T.astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    out = whole(a).astype(object) @ whole(b).astype(object).T if len(a) and len(b) else np.zeros((len(a), len(b)), object)
    return np.clip(out, _LEAST, _MOST).astype(np.int64)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of one query, ties to smaller ids."""
    if len(ids) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = scores >= least
        ids, scores = ids[keep], scores[keep]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


_FOUND = "block long, query_id long, vec_id long, score long"


def _bucket_best(row: dict, queries: tuple[np.ndarray, np.ndarray, np.ndarray], least: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, ids, scores) of one bucket: at most k of each query, and none that its least score excludes."""
    ids, vectors, norms = _unpack(row)
    qids, asked, qnorms = queries
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where((least > 0) & (qnorms > 0), least / qnorms * (1 - 1e-9), 0.0)  # of a partner's length
    cosine = need / max(row["longest"], 1e-300)
    open_ = np.flatnonzero(cosine <= 1)

    def take(q: int, at: np.ndarray, scores: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        ok = (scores >= least[q]) & (ids[at] != qids[q])
        return q, *_best(ids[at][ok], scores[ok], k)

    longest = row["longest"] * (float(qnorms.max()) if len(qnorms) else 0.0)
    for q in open_[cosine[open_] >= COORDINATE_COSINE]:
        # with coordinates u and x of two unit vectors their cosine is at most u x + sqrt((1 - u u)(1 - x x))
        at = np.arange(int(np.searchsorted(-norms, -need[q], "right")))
        unit = asked[q] / qnorms[q]
        for f in np.argsort(-np.abs(unit))[:FOCUS]:
            u, x = unit[f], vectors[at, f] / norms[at]
            at = at[u * x + np.sqrt(np.maximum(0, (1 - u * u) * (1 - x * x))) >= need[q] / norms[at] - 1e-9]
        yield take(int(q), at, _products(asked[q : q + 1], vectors[at], longest)[0])
    rest = open_[cosine[open_] < COORDINATE_COSINE]
    if len(rest):
        reach = np.searchsorted(-norms, -need[rest], "right")
        scores = _products(asked[rest], vectors[: reach.max()], longest)
        for q, n, s in zip(rest.tolist(), reach.tolist(), scores, strict=True):
            yield take(q, np.arange(n), s[:n])


def _search(k: int):
    """The k best of each query of some blocks in one group."""

    def run(key: tuple[pa.Scalar, ...], buckets: pa.Table, blocks: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 4
        group = sorted(buckets.to_pylist(), key=lambda r: -r["longest"]) if blocks.num_rows else []
        for block in blocks.to_pylist() if group else []:
            queries = _unpack(block)
            n = len(queries[0])
            least = np.frombuffer(block["least"], "<f8").copy() if block["least"] is not None else np.full(n, -np.inf)
            ids: list[np.ndarray] = [np.zeros(0, np.int64)] * n
            scores: list[np.ndarray] = [np.zeros(0, np.int64)] * n
            for row in group:
                for q, v, s in _bucket_best(row, queries, least, k):
                    ids[q], scores[q] = _best(np.concatenate([ids[q], v]), np.concatenate([scores[q], s]), k)
                    if len(ids[q]) == k:
                        least[q] = max(least[q], float(scores[q][-1]) - (abs(float(scores[q][-1])) >= 1 << 53))
            size = [len(x) for x in ids]
            mine = [np.full(sum(size), block["block"]), np.repeat(queries[0], size), np.concatenate(ids), np.concatenate(scores)]
            out = [np.concatenate([x, y]) for x, y in zip(out, mine, strict=True)]
        return pa.table(dict(zip(("block", "query_id", "vec_id", "score"), (x.astype(np.int64) for x in out), strict=True)))

    return run


def _met(buckets: DataFrame, blocks: DataFrame, first: Column, last: Column, k: int) -> DataFrame:
    """Search groups number first to last - 1 for each block. TASK_BLOCKS blocks meet a group in one task."""
    asks = blocks.withColumn("rank", F.explode(F.when(last > first, F.sequence(first, last - 1)))).withColumn("salt", F.floor(F.col("number") / TASK_BLOCKS))
    tasks = asks.groupBy("dim", "rank").agg(F.collect_set("salt").alias("salts"))
    sent = buckets.join(tasks, ["dim", "rank"]).withColumn("salt", F.explode("salts")).drop("salts")
    return sent.groupBy("dim", "rank", "salt").cogroup(asks.groupBy("dim", "rank", "salt")).applyInArrow(_search(k), _FOUND)


def top_k(vectors: DataFrame, query_each: int = QUERY_EACH, k: int = TOP, scale: int = SCALE) -> DataFrame:
    """The k largest integer inner products of each query with all other vectors: query_id, rank (from 1), vec_id, score.

    vectors: (vec_id, embedding). Components become floor(scale * x), x as double. Queries are the vectors whose vec_id is
    divisible by query_each; equal scores go to the smaller vec_id. Vectors that are null, empty, or have null or non-finite
    components, and rows without vec_id, take no part. Vectors of different dimensions have no product. A query never meets a
    row with its own vec_id; of query rows with one vec_id that with the least vector asks; candidate rows with one vec_id each
    count. A product that a long can't hold is the nearest long. Other columns are left out.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = saved(vectors.select("vec_id", "embedding").mapInArrow(_integers(scale), "vec_id long, dim int, norm double, vector binary"), "topk_vectors")
    n, parts_least = rows.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(parts_least // 4, -(-n // (GROUP_BUCKETS * BUCKET)), 1)
    sort = [F.col("dim"), F.col("norm").desc(), F.col("vec_id")]
    packed = rows.repartitionByRange(parts, *sort).sortWithinPartitions(*sort).mapInArrow(_packed(BUCKET), _PACK)
    buckets = saved(packed.withColumn("part", F.spark_partition_id()), "topk_buckets")
    # groups are parts of a dimension, numbered from the longest vectors on; their greatest lengths are 8 bytes for some 30,000 vectors
    groups = buckets.groupBy("dim", "part").agg(F.max("longest").alias("longest")).groupBy("dim").agg(F.array_sort(F.collect_list(F.struct("part", "longest"))).alias("groups"))
    groups = saved(groups, "topk_groups")
    ranks = groups.select("dim", F.posexplode("groups").alias("rank", "g")).select("dim", "rank", F.col("g.part").alias("part"))
    buckets = saved(buckets.join(ranks, ["dim", "part"]).drop("part"), "topk_ranked")
    asking = rows.where(F.col("vec_id") % query_each == 0).groupBy("vec_id").agg(F.min(F.struct("dim", "norm", "vector")).alias("q")).select("vec_id", "q.*")
    blocks = asking.repartitionByRange(max(1, -(-n // (query_each * 4 * BLOCK))), *sort).sortWithinPartitions(*sort).mapInArrow(_packed(BLOCK), _PACK)
    blocks = saved(blocks.withColumns({"block": F.monotonically_increasing_id(), "least": F.lit(None).cast("binary")}), "topk_blocks")
    numbered = blocks.withColumn("number", F.pmod(F.col("block"), F.lit(1 << 33)) + F.shiftright("block", 33) * TASK_BLOCKS)
    seed = saved(_met(buckets, numbered, F.lit(0), F.lit(1), k), "topk_seed")
    kth = seed.groupBy("block", "query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k)
    learnt = blocks.join(kth.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("query_id", "least"))).alias("scores")), "block", "left")
    learnt = saved(learnt.mapInArrow(_with_least, f"block long, {_PACK}, least binary, need double"), "topk_asking")
    reach = F.size(F.filter("groups", lambda g: g["longest"] >= F.col("need")))
    learnt = learnt.join(groups, "dim").withColumns({"reach": reach, "number": F.pmod(F.col("block"), F.lit(1 << 33)) + F.shiftright("block", 33) * TASK_BLOCKS}).drop("groups")
    found = seed.unionByName(_met(buckets, learnt, F.lit(1), F.col("reach"), k))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _with_least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block with its queries' k-th scores so far, and the least length that any of them needs of a partner."""
    for batch in batches:
        for row in batch.to_pylist():
            ids, _, norms = _unpack(row)
            scores = dict(row["scores"] or [])
            least = np.array([scores.get(int(i), -np.inf) for i in ids], "<f8")
            least -= np.abs(least) >= 1 << 53  # a double may stand over the long that it was
            with np.errstate(divide="ignore", invalid="ignore"):
                need = float(np.where((least > 0) & (norms > 0), least / norms * (1 - 1e-9), 0.0).min())
            keep = ["block", "dim", "n", "longest", "kind", "ids", "matrix", "norms"]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.string(), *[pa.binary()] * 3]
            yield pa.RecordBatch.from_arrays([*(pa.array([row[c]], t) for c, t in zip(keep, kinds, strict=True)), pa.array([least.tobytes()], pa.binary()), pa.array([need])], [*keep, "least", "need"])


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


ORACLE = {
    "op9_topk_search": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
}
