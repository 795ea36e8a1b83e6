"""Exact top-k inner products by no-random-access aggregation.

Queries and candidates are dealt into blocks; a task gets one block of
each. In it every dimension is a list of the block's candidates sorted by their
component. For a query the lists are read in step from the end that scores
higher. A candidate's lower bound is the sum of its components read so far plus the
worst value of each list it wasn't met in; its upper bound has the last value
read there instead. Reading stops when neither an unseen candidate nor any outside the current
survivors can reach the k-th largest lower bound; the survivors' final scores are then resolved.
The best k of each block are merged by a ranking over at most k rows of each block.

Bounds are integers, so the result is exact, ties included (the smaller id wins).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from clickscope.llm.common import stage

QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 16384
QUERIES_AT_ONCE = 64
FIRST_DEPTH = 64
POOL = 64
STRETCHES = (1, 2, 3, 4, 5, 6, 8, 10, 12, 16)  # depths, in sixteenths of a list
LEAST = {"f": -np.inf, "i": np.iinfo(np.int64).min}


class Lists:
    """The sorted lists of one block of candidates, and how deep each candidate stands in them."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        by_id = np.argsort(ids, kind="stable")  # ties by id: earlier row, smaller id
        self.ids, self.x = ids[by_id], x[by_id]
        order = np.argsort(-self.x, axis=0, kind="stable")  # a list for each column, largest first
        self.sorted = np.take_along_axis(self.x, order, 0)
        self.place = np.empty(order.shape, np.int32)
        np.put_along_axis(self.place, order, np.arange(len(ids), dtype=np.int32)[:, None], 0)

    def top(self, q: np.ndarray, skip: list, k: int) -> tuple[list, list]:
        """For each query (row of ``q``): the rows of its ``k`` best, and how deep the lists were read.

        ``skip``: for each query the rows that take no part. Lists of positive
        components are read from the top, those of negative ones from the bottom.
        """
        n, least = len(self.x), LEAST[self.x.dtype.kind]
        plus, minus = np.maximum(q, 0), np.minimum(q, 0)
        best, depth, open_ = [None] * len(q), [n] * len(q), np.arange(len(q))
        worst_plus, worst_minus = self.sorted[-1], self.sorted[0]
        pool = None
        for m in sorted({min(n, max(FIRST_DEPTH, n * s // 16)) for s in STRETCHES}):
            head, tail = self.sorted[m - 1], self.sorted[n - m]  # last values read

            def bounds(rows, above, below):  # values read so far, and these for what is not
                return (plus[rows] @ np.where(self.place < m, self.x, above).T
                        + minus[rows] @ np.where(self.place >= n - m, self.x, below).T)

            def lower(rows):
                low = bounds(rows, worst_plus, worst_minus)
                for j, i in enumerate(rows):
                    low[j, skip[i]] = least
                return low

            def kth(low):  # the k-th largest lower bound, if there are k candidates
                return np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k] if low.shape[1] >= k else np.full(len(low), least)

            # The lower bounds of the candidates that led at first are kept up with the lists; their k-th largest says
            # whether an unseen candidate may still qualify. Only if none may, all bounds are worked out.
            if pool is None:
                low = lower(open_)
                floor = kth(low)
                pool = np.argpartition(-low, min(POOL, n) - 1, axis=1)[:, :POOL]
            else:
                at, x = self.place[pool[open_]], self.x[pool[open_]]
                low = (np.einsum("qd,qpd->qp", plus[open_], np.where(at < m, x, worst_plus))
                       + np.einsum("qd,qpd->qp", minus[open_], np.where(at >= n - m, x, worst_minus)))
                for j, i in enumerate(open_):
                    low[j, np.isin(pool[i], skip[i])] = least
                floor = kth(low)
            unseen = plus[open_] @ head + minus[open_] @ tail  # the most an unseen candidate can score
            ready = np.flatnonzero((unseen < floor) | (m == n))
            done = np.zeros(len(open_), bool)
            if len(ready):
                floors, highs = kth(lower(open_[ready])), bounds(open_[ready], head, tail)
            for t, j in enumerate(ready):
                i, alive = open_[j], highs[t] >= floors[t]
                alive[skip[i]] = False
                rows = np.flatnonzero(alive)
                if m < n and len(rows) > max(4 * k, n // 8):
                    continue
                score = self.x[rows] @ q[i]  # resolve
                pick = np.lexsort((rows, -score))[:k]
                best[i], depth[i], done[j] = (rows[pick], score[pick]), m, True
            open_ = open_[~done]
            if not len(open_):
                break
        return best, depth


def _block_top(k: int):
    kind = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("times", pa.int64())])

    def matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        flat = pa.concat_arrays([c.flatten() for c in t.column("x").chunks]) if t.num_rows else pa.array([], pa.int64())
        x = flat.to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)
        return t.column("id").to_numpy(), x

    def run(key, queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not queries.num_rows or not candidates.num_rows:
            return kind.empty_table()
        (qid, q), (cid, x) = matrix(queries), matrix(candidates)
        # float64 products are exact while every partial sum stays below 2^53
        most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * x.shape[1] * 4
        if most < 2.0 ** 53:
            q, x = q.astype(np.float64), x.astype(np.float64)
        lists, found = Lists(cid, x), []
        times = np.minimum(candidates.column("times").to_numpy(), k)[np.argsort(cid, kind="stable")]
        for i in range(0, len(qid), QUERIES_AT_ONCE):
            ids = qid[i:i + QUERIES_AT_ONCE]
            first, last = np.searchsorted(lists.ids, ids, "left"), np.searchsorted(lists.ids, ids, "right")
            best, _ = lists.top(q[i:i + QUERIES_AT_ONCE], [np.arange(a, b) for a, b in zip(first, last)], k)
            found += [(np.full(len(r), j), lists.ids[r], s.astype(np.int64), times[r]) for j, (r, s) in zip(ids, best)]
        cols = [np.concatenate(c) for c in zip(*found)]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=kind)

    return run


def quantised(vectors: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """``(id, x array<bigint>)``: floor(scale * component); vectors with a null id, that are null or empty
    or hold null or non-finite components are left out."""
    e = F.col(embedding).cast("array<double>")
    fine = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (vectors.where(F.col(vec_id).isNotNull() & e.isNotNull() & (F.size(e) > 0) & fine)
            .select(F.col(vec_id).cast("bigint").alias("id"),
                    F.transform(e, lambda v: F.floor(v * scale).cast("bigint")).alias("x")))


def top_k(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 5,
          scale: int = 256, every: int = 50, query_block: int = QUERY_BLOCK,
          candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best of all other vectors for each vector whose id divides by ``every``.

    Ties go to the smaller vec_id. Rows with the query's own id are no candidates of
    it. A repeated row is a candidate each time, and one query; rows with one id but
    different vectors, and vectors of different lengths, are compared as
    they are (lengths: with vectors of their own length only). Vectors that are null, empty, or hold null or
    non-finite components take no part. An empty table gives no row. Scores
    beyond 64 bits aren't supported.
    """
    v = stage(quantised(vectors, vec_id, embedding, scale).groupBy("id", "x").agg(F.count(F.lit(1)).alias("times"))
              .withColumn("dims", F.size("x")), "topk_vectors")
    n, m = v.agg(F.count(F.lit(1)), F.count(F.when(F.pmod("id", F.lit(every)) == 0, 1))).first()
    nq, nc = -(-m // query_block) or 1, -(-n // candidate_block) or 1
    # numpy arrays of a pair of blocks are a task's memory; blocks are dealt by hash, hot ids or not
    block = F.xxhash64("id", "x")
    queries = (v.where(F.pmod("id", F.lit(every)) == 0).withColumn("qb", F.pmod(block, F.lit(nq)))
               .withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(nc - 1)).cast("array<bigint>"))))
    candidates = (v.withColumn("cb", F.pmod(block, F.lit(nc)))
                  .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1)).cast("array<bigint>"))))
    keys = ["dims", "qb", "cb"]
    found = (queries.groupBy(*keys).cogroup(candidates.groupBy(*keys))
             .applyInArrow(_block_top(k), "query_id long, vec_id long, score long, times long"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times"))))  # at most k
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
