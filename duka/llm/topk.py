"""Exact top-k inner products by block-at-a-time pruning.

Vectors are integers floor(256 x). Documents are dealt to shards and, within a
shard, ordered by the nearest of a few centres, so that a block is a range of like documents. Each block keeps the maximum and the
minimum of every term (dimension), so a query's score with any document of
the block is at most sum(max(q*max, q*min)). A query visits the blocks by
falling bound, scores a block through its forward index (the block's rows),
and stops when the bound falls below its k-th score (or ties it with larger
ids only). Each (query group, shard) tile is one task's work of bounded size;
the tiles' best k per query are merged by a ranked window.

Defined results: a vector that is null or holds null or non-finite components,
or has no vec_id, takes no part; components that the shorter of two vectors
lacks count 0; rows with the same vec_id are one row (the least vector);
ties go to the smaller vec_id; fewer candidates give fewer rows; an empty table
gives an empty result; other columns are ignored. Sums are exact in int64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

K = 5
SHARD_ROWS = 8192
GROUP_ROWS = 16384
BLOCK = 128
ROUNDS = 4          # of moving the centres


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    rows = vectors.combine_chunks()
    n = rows.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(rows), width), np.int64)
    out[np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = \
        rows.flatten().to_numpy(zero_copy_only=False)
    return out


def _width(t: pa.Table) -> int:
    return max(t.column("v").combine_chunks().value_lengths().to_numpy(zero_copy_only=False), default=0)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T exactly; through doubles where every partial sum stays below 2^53."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def ranges(did: np.ndarray, d: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts): documents by nearest centre, then id, and where blocks of at most
    `block` documents of one centre start. The centres begin at evenly spaced documents and
    move to the means of theirs, so the blocks depend on the documents alone."""
    n = max(1, len(did) // block)
    x = d.astype(np.float64)
    centres = x[np.linspace(0, len(did) - 1, n).astype(int)]
    for step in range(ROUNDS + 1):
        near = np.concatenate([np.argmax(x[k:k + 4096] @ centres.T - (centres**2).sum(1) / 2, axis=1)
                               for k in range(0, len(x), 4096)])
        if step < ROUNDS:
            count = np.bincount(near, minlength=n)
            by = np.argsort(near, kind="stable")
            used = np.flatnonzero(count)
            centres[used] = np.add.reduceat(x[by], (np.cumsum(count) - count)[used]) / count[used][:, None]
    order = np.lexsort((did, near))
    first = np.flatnonzero(np.r_[True, np.diff(near[order]) != 0])
    stops = np.r_[first[1:], len(did)]
    return order, np.concatenate([np.arange(a, b, block) for a, b in zip(first, stops)])


def search(qid: np.ndarray, q: np.ndarray, did: np.ndarray, d: np.ndarray, k: int = K, block: int = BLOCK):
    """Best k of the documents (sorted by id) for each query: (ids, scores),
    -1 where there is none, and the share of (query, document) pairs that were scored."""
    order, starts = ranges(did, d, block)
    did, d = did[order], d[order]
    stops = np.r_[starts[1:], len(did)]
    high, low = np.maximum.reduceat(d, starts), np.minimum.reduceat(d, starts)
    least = np.minimum.reduceat(did, starts)
    bound = _product(np.maximum(q, 0), high) + _product(np.minimum(q, 0), low)
    order = np.argsort(-bound, axis=1, kind="stable")
    none = np.iinfo(np.int64).min
    best = np.full((len(qid), k), none)
    ids = np.full((len(qid), k), -1, np.int64)
    live, scored = np.arange(len(qid)), 0
    for rank in range(len(starts)):
        b = order[live, rank]
        top, kth, kid = bound[live, b], best[live, -1], ids[live, -1]
        # below the k-th score nothing of this or a later block can enter; a tie enters by a smaller id only,
        # and a later block of the same bound may hold one, so ties stay in play but skip this block
        stay = (kth == none) | (top >= kth)
        live, b, tied = live[stay], b[stay], (top == kth)[stay] & (least[b] > kid)[stay]
        if not len(live):
            break
        for one in np.unique(b[~tied]):
            rows = live[~tied & (b == one)]
            s = slice(starts[one], stops[one])
            scored += len(rows) * (s.stop - s.start)
            got = _product(q[rows], d[s])
            got[did[s][None] == qid[rows][:, None]] = none
            every = np.hstack([best[rows], got])
            name = np.hstack([ids[rows], np.broadcast_to(did[s], got.shape)])
            pick = np.lexsort((name, -np.maximum(every, none + 1)), axis=1)[:, :k]
            best[rows], ids[rows] = np.take_along_axis(every, pick, 1), np.take_along_axis(name, pick, 1)
    ids[best == none] = -1
    return ids, best, scored / max(1, len(qid) * len(did))


def top_k(vectors: DataFrame, is_query: Column, k: int = K, shard_rows: int = SHARD_ROWS,
          group_rows: int = GROUP_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of each query."""
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("bigint"))
    ok = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where("vec_id is not null and embedding is not null").where(ok) \
        .select(F.col("vec_id").cast("bigint").alias("vec_id"), whole.alias("v"), is_query.alias("asks")) \
        .groupBy("vec_id").agg(F.min("v").alias("v"), F.max("asks").alias("asks"))
    count = vectors.agg(F.count("vec_id").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    shards, groups = count.n // shard_rows + 1, count.q // group_rows + 1

    def dealt(n: int):
        return F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    docs = rows.select("vec_id", "v", dealt(shards).alias("s"), every(groups).alias("g"))
    asks = rows.where("asks").select("vec_id", "v", dealt(groups).alias("g"), every(shards).alias("s"))

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        right = right.sort_by("vec_id")
        width = max(_width(left), _width(right))
        qid, did = left.column("vec_id").to_numpy(), right.column("vec_id").to_numpy()
        ids, best, _ = search(qid, _matrix(left.column("v"), width), did, _matrix(right.column("v"), width), k)
        found = best > np.iinfo(np.int64).min
        return pa.table({"query_id": np.repeat(qid, found.sum(1)), "vec_id": ids[found], "score": best[found]})

    found = asks.groupBy("g", "s").cogroup(docs.groupBy("g", "s")).applyInArrow(
        tile, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of every row for the rows whose vec_id is divisible by 50."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM p QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""
