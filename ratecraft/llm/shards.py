"""Vectors in shards, each shard met by a stream of query vectors.

A shard is a bounded number of vectors that fits in a task; every query row is
sent to every shard and streams past it in batches.  ``handler(d, ids, vecs, weights)``
builds whatever the shard needs; ``.answer(ids, vecs)`` and ``.finish()`` return
record batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite_vector(col: Column) -> Column:
    """True for a vector with components that are all present and finite."""
    fine = F.forall(col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(fine & (F.size(col) > 0), F.lit(False))


def shard_count(rows: int, shard_rows: int, least: int) -> int:
    return max(least, -(-rows // shard_rows))


def meet(members: DataFrame, queries: DataFrame, shards: int, handler: Callable, schema: str,
         query_rows: int = 512) -> DataFrame:
    """Run ``handler`` over every shard of ``members`` (id, vec, weight) and all of ``queries`` (id, vec).

    Vectors of different lengths never meet: a shard is cut again by length.
    A task holds one shard and ``query_rows`` queries at a time.
    """
    spread = F.pmod(F.xxhash64(F.lit("shard"), F.col("id")), F.lit(shards)).cast("int")
    vec = F.col("vec").cast("array<double>")
    inside = members.select(spread.alias("shard"), F.size("vec").alias("d"), F.lit(0).alias("kind"), "id",
                            vec.alias("vec"), "weight")
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
                           F.size("vec").alias("d"), F.lit(1).alias("kind"), "id", vec.alias("vec"),
                           F.lit(0).cast("long").alias("weight"))
    rows = (inside.union(asked).repartitionByRange(shards, "shard")
            .sortWithinPartitions("shard", "d", "kind", "id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, held = None, None, []
        for batch in batches:
            shard, d, kind = (batch.column(i).to_numpy() for i in range(3))
            edges = np.flatnonzero((np.diff(shard) != 0) | (np.diff(d) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip([0, *edges], [*edges, len(shard)]):
                if lo == hi:
                    continue
                if key != (shard[lo], d[lo]):
                    if held:
                        state = _built(handler, held, int(key[1]))
                    if state is not None:
                        yield from state.finish()
                    key, state, held = (shard[lo], d[lo]), None, []
                ids = batch.column(3).to_numpy()[lo:hi]
                vecs = _matrix(batch.column(4).slice(lo, hi - lo), int(d[lo]))
                if kind[lo] == 0:
                    held.append((ids, vecs, batch.column(5).to_numpy()[lo:hi]))
                    continue
                if held:
                    state, held = _built(handler, held, int(d[lo])), []
                if state is not None:
                    for k in range(0, len(ids), query_rows):
                        yield from state.answer(ids[k:k + query_rows], vecs[k:k + query_rows])
        if held:
            state = _built(handler, held, int(key[1]))
        if state is not None:
            yield from state.finish()

    return rows.mapInArrow(run, schema)


def _built(handler: Callable, held: list, d: int):
    return handler(d, *(np.concatenate(x) for x in zip(*held)))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, d)
