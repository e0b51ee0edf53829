"""Sort, paging and top-k and set operations (§2.8 U1-U4)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.operators.paging import PageIndex
from ratecraft.operators.windows import row_index


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group in ``order`` (a total order).

    ``row_number() <= k`` is planned with a window group limit on both sides
    of the shuffle, so each map task forwards at most ``k`` rows per group:
    a hot group never reaches the reducer whole.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Global top-k (TakeOrderedAndProject: per-task top-k, then merge)."""
    return df.orderBy(*order).limit(k)


def top_k_arrays(df: DataFrame, key: str, order: Sequence[Column], k: int,
                 fields: Sequence[str], out: str = "recommendations") -> DataFrame:
    """Top-k per key packed as ``array<struct<fields>>`` in rank order
    (bounded: at most k elements per key)."""
    ranked = top_k_per_group(df, [key], order, k, "_rank")
    packed = F.array_sort(F.collect_list(F.struct(F.col("_rank"), *[F.col(f) for f in fields])))
    agg = ranked.groupBy(key).agg(packed.alias("_arr"))
    return agg.select(key, F.transform("_arr", lambda s: F.struct(*[s[f].alias(f) for f in fields])).alias(out))


def paginate(df: DataFrame, order: Sequence[str], page: int, per_page: int = 10) -> DataFrame:
    """Rows ``[(page-1)*per_page, page*per_page)`` of the total ``order`` (nulls first).

    For one page of a table that no index holds yet; keep the ``PageIndex`` to
    read more of them.  Page 0 or a page past the end is empty.
    """
    if per_page < 1:
        raise ValueError("per_page must be >= 1")
    return PageIndex.build(df, order).page(page, per_page).select(*df.columns)


def page_numbers(df: DataFrame, order: Sequence[str], per_page: int = 10,
                 col: str = "page") -> DataFrame:
    """Every row with its 1-based page number and position."""
    idx = row_index(df, order, name="position")
    return idx.withColumn(col, (F.floor(F.col("position") / F.lit(per_page)) + 1).cast("long"))


# set operations -----------------------------------------------------------------------
def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
