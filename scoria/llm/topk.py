"""Exact top-k inner products with multi-resolution segment statistics.

For a segment of a vector with mean m and deviation s, two vectors' inner
product over the segment is at most ``length * (m m' + s s')``: the other
side of the lower bound on their distance by means and deviations.  Sums
over 1, 2, 4, ... segments are bounds from coarse to fine.  Candidates are
read in blocks by rising id; a pair is dropped as soon as a bound does not
exceed the query's k-th best score so far (a later id loses ties), and
what survives the finest level is computed exactly in integers.

Queries and candidates are cut into blocks that meet pairwise, one task
per pair of blocks, so memory is bounded by the two blocks; each task
returns k rows per query, and the best k of those are kept.

Defined cases: vectors that are null, empty, or hold null or non-finite
components take no part; only vectors of equal length are compared; every
row is a candidate of every other row, repeated rows and rows of the same
id included; null ids take no part; fewer candidates than k give all of
them; ties go to the smaller id; empty tables give empty results.
Quantised components beyond 2**24 in size (or sums beyond 2**53) are
compared by whole numbers of any size throughout, without bounds; a score
beyond a long counts as the largest or smallest long.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoria.llm.common import col
from scoria.session import cut_lineage

__all__ = ["finite", "quantize", "top_k", "BLOCK"]

#: Vectors in a block of candidates, and of queries.
BLOCK = 4096
CHUNK = 512


def finite(vector: Column) -> Column:
    """The components as doubles; null where one is null or not finite, or where there are none."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & (F.size(vector) > 0),
                  F.transform(vector, lambda x: x.cast("double")))


def quantize(x: np.ndarray, scale: int = 64) -> np.ndarray:
    """floor(scale * x) as whole numbers; of any size, where a component passes 2**53."""
    if np.abs(x).max(initial=0) < 2.0 ** 53 / scale:
        return np.floor(scale * x).astype(np.int64)
    return np.array([[int(c) * scale if abs(c) >= 2.0 ** 53 else math.floor(scale * c) for c in row] for row in x.tolist()], object)


def _levels(x: np.ndarray) -> list[np.ndarray]:
    """Per level: segment means and deviations, scaled so that a bound is a plain inner product."""
    out, dim, n = [], x.shape[1], 1
    while n <= dim // 4 or n == 1:
        edges = np.linspace(0, dim, n + 1).astype(int)
        size = np.diff(edges)
        mean = np.add.reduceat(x, edges[:-1], axis=1) / size
        square = np.add.reduceat(x * x, edges[:-1], axis=1) / size
        dev = np.sqrt(np.maximum(square - mean * mean, 0))
        out.append(np.concatenate((mean, dev), axis=1) * np.sqrt(np.concatenate((size, size))))
        n *= 2
    return out


def _best(qid, q, cid, c, k):
    """(query row, candidate row, score) of the k best candidates of each query; candidates by rising id.
    ``qid`` and ``cid`` name rows, a query does not meet its own."""
    n, dim = q.shape
    if q.dtype == object or c.dtype == object:
        return _best_whole(qid, q, cid, c, k)
    most = float(np.abs(q).max(initial=0)), float(np.abs(c).max(initial=0))
    if max(most) > 1 << 24 or most[0] * most[1] * dim >= 1 << 53:
        return _best_whole(qid, q, cid, c, k)
    top = np.full((n, k), -np.inf)  # scores, best first; whole numbers below 2**53
    who = np.full((n, k), -1, np.int64)
    q, c = q.astype(np.float64), c.astype(np.float64)
    ql, cl = _levels(q), _levels(c)
    # more than the rounding of the bounds, far less than the step between scores
    slack = 1e-9 * np.sqrt((q * q).sum(1).max(initial=0) * (c * c).sum(1).max(initial=0)) + 1e-6
    for a in range(0, len(cid), CHUNK):
        rows, cols = np.arange(n), np.arange(a, min(a + CHUNK, len(cid)))
        for lq, lc in zip(ql, cl):
            alive = lq[rows] @ lc[cols].T + slack > top[rows, -1][:, None]
            rows, cols = rows[alive.any(1)], cols[alive.any(0)]
            if not len(rows) or not len(cols):
                break
        if not len(rows) or not len(cols):
            continue
        score = q[rows] @ c[cols].T
        score[qid[rows][:, None] == cid[cols][None, :]] = -np.inf
        # a new score must beat the k-th: on ties the smaller id, read before, stays
        hit = (score > top[rows, -1][:, None]).any(1)
        rows, score = rows[hit], score[hit]
        both = np.concatenate((top[rows], score), axis=1)
        ids = np.concatenate((who[rows], np.broadcast_to(cols, score.shape)), axis=1)
        pick = np.argsort(-both, axis=1, kind="stable")[:, :k]
        top[rows] = np.take_along_axis(both, pick, 1)
        who[rows] = np.take_along_axis(ids, pick, 1)
    r, j = np.nonzero(top > -np.inf)
    return r, who[r, j], top[r, j].astype(np.int64)


def _best_whole(qid, q, cid, c, k):
    """The same by whole numbers of any size; scores beyond a long are equal to the last long there."""
    q, c = q.astype(object), c.astype(object)
    out = []
    for i in range(len(qid)):
        score = c @ q[i]
        score = [max(-(1 << 63), min((1 << 63) - 1, s)) for s in score]
        best = sorted((-s, j) for j, s in enumerate(score) if cid[j] != qid[i])[:k]
        out += [(i, j, -s) for s, j in best]
    return [np.array(x, np.int64) for x in zip(*out)] if out else [np.empty(0, np.int64)] * 3


def top_k(vectors: DataFrame, is_query: Column, *, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 64, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of the quantised vectors."""
    v = vectors.select(col(id_col).cast("long").alias("vec_id"), finite(col(vector_col)).alias("v"), is_query.alias("q"))
    v = v.where(F.col("v").isNotNull() & F.col("vec_id").isNotNull())
    # row numbers, fixed by the checkpoint: a repeated row is another row, as candidate and as query
    v = cut_lineage(v.withColumn("row", F.monotonically_increasing_id()).withColumn("h", F.xxhash64("row")))
    n, nq = v.agg(F.count("*"), F.coalesce(F.sum(F.col("q").cast("long")), F.lit(0))).first()
    cb, qb = max(1, -(-n // block)), max(1, -(-nq // block))
    # small tables: blocks for every core, so that no task holds all pairs
    cb = max(cb, min(2 * vectors.sparkSession.sparkContext.defaultParallelism, -(-n // 64) or 1))
    c = v.select(F.pmod("h", F.lit(cb)).alias("cb"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(qb - 1).cast("long"))).alias("qb"),
                 F.size("v").alias("dim"), "vec_id", "row", "v")
    q = v.where("q").select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cb - 1).cast("long"))).alias("cb"),
                            F.pmod(F.shiftright("h", 20), F.lit(qb)).alias("qb"), F.size("v").alias("dim"), "vec_id", "row", "v")

    def meet(qs: pa.Table, cs: pa.Table) -> pa.Table:
        if not qs.num_rows or not cs.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "query_row": pa.array([], pa.int64()),
                             "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        qid, q_row, qv = qs["vec_id"].to_numpy(), qs["row"].to_numpy(), quantize(_matrix(qs), scale)
        cid, c_row, cv = cs["vec_id"].to_numpy(), cs["row"].to_numpy(), quantize(_matrix(cs), scale)
        order = np.argsort(cid, kind="stable")
        cid, c_row, cv = cid[order], c_row[order], cv[order]
        r, j, score = _best(q_row, qv, c_row, cv, k)
        return pa.table({"query_id": qid[r], "query_row": q_row[r], "vec_id": cid[j], "score": score})

    keys = ["cb", "qb", "dim"]
    near = q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInArrow(meet, "query_id long, query_row long, vec_id long, score long")
    best = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return near.select("query_id", "rank", "vec_id", "score")


def _matrix(t: pa.Table) -> np.ndarray:
    v = t["v"].combine_chunks()
    flat = v.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(t.num_rows, -1)
