"""Equality of tables as multisets in one pass.

A row becomes two 64-bit hashes with different seeds; a table's fingerprint is
its row count and the two sums.  Sums do not depend on the order of rows or on
how they are partitioned, repeated rows count as often as they occur, and the
fingerprints of parts add up to that of the whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEEDS = (17, 4_611_686_018_427_387_847)


def row_hash(columns: Sequence[str], seed: int) -> Column:
    """A hash of the row; nulls are told apart by their place, which the plain hash does not."""
    return F.xxhash64(F.lit(seed), *[x for c in columns for x in (F.col(c), F.col(c).isNull())])


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(by..., n, f1, f2) of ``columns`` (all, unless given): one aggregate, partial before the shuffle."""
    columns = list(columns or [c for c in df.columns if c not in by])
    sums = [F.coalesce(F.sum(row_hash(columns, s).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias(f"f{i}")
            for i, s in enumerate(SEEDS, 1)]
    return df.groupBy(*by).agg(F.count("*").alias("n"), *sums)


def same_rows(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row (n_left, n_right, same): whether both hold the same rows, each as often.

    Values are compared in the types of ``left``.  Different multisets pass as
    the same only if both 64-bit sums agree by chance.  No join, no sort: both
    sides are hashed where they lie.
    """
    columns = list(columns or left.columns)
    cast = [F.col(c).cast(left.schema[c].dataType).alias(c) for c in columns]
    both = (left.select(*columns, F.lit(True).alias("_left"))
            .unionByName(right.select(*cast).withColumn("_left", F.lit(False))))
    parts = fingerprint(both, columns, ["_left"])

    def of(side: bool, col: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_left") == side, F.col(col))), F.lit(0))

    return parts.agg(of(True, "n").alias("n_left"), of(False, "n").alias("n_right"),
                     (F.struct(*[of(True, c) for c in ("n", "f1", "f2")])
                      == F.struct(*[of(False, c) for c in ("n", "f1", "f2")])).alias("same"))
