"""Exact top-k by inner product with Fagin's threshold algorithm, shard by shard.

Each shard keeps one list per dimension, sorted by value.  A query reads the
lists of its non-zero dimensions from the end that favours it, in growing
steps; every vector met is scored in full, and the query stops once the bound
on all vectors not yet met is below its kth score.  Integers throughout, so
scores and ties are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shards import finite_vector, meet, shard_count

FIRST_DEPTH = 16


class _Lists:
    """Sorted lists of one shard; ids rise with the row, so a smaller row wins ties."""

    def __init__(self, k: int, ids: np.ndarray, vecs: np.ndarray):
        at = np.argsort(ids, kind="stable")
        self.k, self.ids = k, ids[at]
        big = float(np.abs(vecs).max(initial=0.0))
        self.big, self.d = big, vecs.shape[1]
        self.x = vecs[at]
        self.falling = np.argsort(-self.x, axis=0, kind="stable").astype(np.int32)  # [depth, dimension]

    def _scores(self, rows: np.ndarray | slice, q: np.ndarray) -> np.ndarray:
        if self.big * float(np.abs(q).max(initial=0.0)) * self.d < 2 ** 52:
            return (self.x[rows] @ q).astype(np.int64)  # every partial sum is an exact double
        return np.array([sum(int(a) * int(b) for a, b in zip(row, q)) for row in self.x[rows]], dtype=object)

    def top(self, q: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the query's best k in this shard, its own id left out."""
        n = len(self.ids)
        dims = np.flatnonzero(q)
        if not len(dims):  # every score is 0: the smallest ids win
            rows = np.flatnonzero(self.ids != own)[:self.k]
            return rows, np.zeros(len(rows), dtype=np.int64)
        met = np.zeros(n, dtype=bool)
        met[self.ids == own] = True
        best_rows, best = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        up, down = dims[q[dims] > 0], dims[q[dims] < 0]
        lo, depth = 0, min(FIRST_DEPTH, n)
        while True:
            new = np.zeros(n, dtype=bool)
            new[self.falling[lo:depth, up].ravel()] = True
            new[self.falling[n - depth:n - lo, down].ravel()] = True
            rows = np.flatnonzero(new & ~met)
            met |= new
            best_rows = np.concatenate([best_rows, rows])
            best = np.concatenate([best, self._scores(rows, q)])
            order = np.lexsort((best_rows, -best))[:self.k]
            best_rows, best = best_rows[order], best[order]
            if depth == n or met.all():
                return best_rows, best
            edge = np.concatenate([self.x[self.falling[depth, up], up], self.x[self.falling[n - 1 - depth, down], down]])
            bound = sum(int(a) * int(b) for a, b in zip(edge, np.concatenate([q[up], q[down]])))
            if len(best) == self.k and int(best[-1]) > bound:
                return best_rows, best
            lo, depth = depth, min(n, 4 * depth)


def search(members: DataFrame, queries: DataFrame, k: int, shard_rows: int = 100_000, shards: int = 6) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` best members of every query by integer inner product.

    ``members`` and ``queries`` have (id, vec) with whole numbers as doubles;
    a query's own id is no candidate, ties go to the smaller id.  Vectors of
    another length than the query's are no candidates.  Each shard returns at
    most ``k`` rows per query, so the merge is bounded.
    """
    class Shard:
        def __init__(self, d, ids, vecs, weights):
            self.lists = _Lists(k, ids, vecs)

        def answer(self, ids, vecs) -> Iterator[pa.RecordBatch]:
            got = [self.lists.top(q, i) for i, q in zip(ids.tolist(), vecs)]
            counts = [len(r) for r, _ in got]
            rows = np.concatenate([r for r, _ in got]) if got else np.zeros(0, int)
            scores = [int(s) for _, part in got for s in part]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, counts), pa.int64()), pa.array(self.lists.ids[rows], pa.int64()),
                 pa.array(scores, pa.int64())], names=["query_id", "id", "score"])

        def finish(self) -> Iterator[pa.RecordBatch]:
            return iter(())

    n = shard_count(members.count(), shard_rows, shards)
    found = meet(members.withColumn("weight", F.lit(1).cast("long")), queries, n, Shard,
                 "query_id long, id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "id", "score"))


def quantised(vec: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, taken as a double."""
    return F.transform(vec, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double"))


def top_neighbours(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 50, k: int = 5,
                   shard_rows: int = 100_000, shards: int = 6) -> DataFrame:
    """Top ``k`` neighbours of the rows whose id is divisible by ``every``, among all other rows.

    Rows with a null id, a null or empty vector, or null or non-finite
    components take no part.  Repeated rows of one id count once.  No rows, or
    no query, give no rows; other columns are not read.
    """
    rows = (df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
            .where(F.col("id").isNotNull() & finite_vector(F.col("vec")))
            .select("id", quantised(F.col("vec")).alias("vec")).distinct())
    return search(rows, rows.where(F.col("id") % every == 0), k, shard_rows, shards)
