"""Order-dependent operators that survive hot keys.

A plain ``Window.partitionBy(key).orderBy(seq)`` puts every row of a key in
one task; one movie holding a third of all ratings would then sort a third
of the data in a single task.  ``running_stats`` is a two-level prefix sum
instead:

1. rows are range-partitioned on the FULL tuple (keys, order), sorted there and
   written once with their part and their place in it: a hot key, an outlier, a
   string or a null order value all end in parts of about equal size;
2. with no key, a row's position is its part's start plus its place: one small
   aggregate over the parts, no window and no further shuffle of the rows;
3. a row number per key is a position less that of the key's first row;
4. running sums take a window inside each (key, chunk of a part); per (key,
   chunk) totals (a partial aggregate, so small) are prefix-summed over chunks
   and joined back null-safely.

The number of parts is ``spark.sql.shuffle.partitions``, whatever the rows; large
parts are cut into chunks by place.  Only rows equal in the whole tuple cannot be
told apart; a total order has none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.session import work_dir

DEFAULT_ROWS_PER_CHUNK = 1 << 20
PLACE_BITS = (1 << 33) - 1  # monotonically_increasing_id: partition above, row number in these bits


def in_order(df: DataFrame, by: Sequence[str], parts: int | None = None) -> DataFrame:
    """The rows in range partitions, sorted, with ``_part`` (ascending with ``by``, nulls first) and
    ``_at``, the 0-based place in the part.  To be written before use: places must not change
    between the steps that read them."""
    ranged = df.repartitionByRange(parts, *by) if parts else df.repartitionByRange(*by)
    placed = ranged.withColumn("_part", F.spark_partition_id()).sortWithinPartitions("_part", *by)
    return placed.withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE_BITS)))


def lay_down(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """``in_order`` rows, written to the shared work folder and read back: a lost executor changes nothing."""
    rows = in_order(df, by)
    path = work_dir(df.sparkSession, "ordered") + "/rows"
    rows.write.parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def part_starts(laid: DataFrame, part: str = "_part") -> DataFrame:
    """(part, start, total): rows before each part and rows in all.  One row a part, so at most as many
    as there are shuffle partitions, which bounds the window and any broadcast of it."""
    sizes = laid.groupBy(F.col("_part").alias(part)).agg((F.max("_at") + 1).alias("_n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return sizes.select(part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
                        F.sum("_n").over(every).alias("_total"))


def _positions(laid: DataFrame) -> DataFrame:
    """The rows with their global 0-based ``_pos`` and the number of rows in all, ``_total``."""
    starts = F.broadcast(part_starts(laid, "_p"))  # bounded by the shuffle partitions
    return laid.join(starts, F.col("_part") == F.col("_p")).withColumn("_pos", F.col("_start") + F.col("_at")).drop(
        "_p", "_start", "_part", "_at")


def _same(keys: Sequence[str]) -> list:
    return [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]


def _row_numbers(laid: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Per key, the 1-based number of every row: its position less that of the key's first row."""
    rows = _positions(laid).drop("_total")
    firsts = rows.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.min("_pos").alias("_first"))
    return rows.join(firsts, _same(keys)).withColumn(name, F.col("_pos") - F.col("_first") + 1).drop(
        "_pos", "_first", *[f"_k_{k}" for k in keys])


def running_stats(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  value: str | None = None, *, count_col: str = "run_count",
                  sum_col: str = "run_sum", mean_col: str | None = "run_mean",
                  rows_per_chunk: int = DEFAULT_ROWS_PER_CHUNK) -> DataFrame:
    """Per key, the count (and sum/mean of ``value``) of rows up to and
    including the current one in ``order`` (nulls first, ties broken by the
    full order).

    ``count_col`` is the 1-based row number.  Null keys are one key.  Sums of
    doubles are grouped by chunk, so their last bits may differ between chunkings.
    """
    keys, order = list(keys), list(order)
    laid = lay_down(df, [*keys, *order])
    if not value:
        if keys:
            return _row_numbers(laid, keys, count_col)
        return _positions(laid).withColumn(count_col, F.col("_pos") + 1).drop("_pos", "_total")
    chunk = F.col("_part").cast("long") * F.lit(1 << 31) + F.floor(F.col("_at") / F.lit(rows_per_chunk))
    base = laid.withColumn("_chunk", chunk)
    w_in = (Window.partitionBy(*keys, "_chunk").orderBy("_at")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    val = F.col(value).cast("double")
    inner = base.withColumns({"_c_in": F.count(F.lit(1)).over(w_in), "_s_in": F.sum(val).over(w_in),
                              "_n_in": F.count(val).over(w_in)})
    totals = base.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_c_tot"), F.sum(val).alias("_s_tot"),
                                               F.count(val).alias("_n_tot"))
    # one row per (key, chunk); with no key one row per chunk, never the rows
    w_off = Window.orderBy("_chunk") if not keys else Window.partitionBy(*keys).orderBy("_chunk")
    w_off = w_off.rowsBetween(Window.unboundedPreceding, -1)
    offs = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_chunk").alias("_k_chunk"),
        F.coalesce(F.sum("_c_tot").over(w_off), F.lit(0)).alias("_c_off"),
        F.coalesce(F.sum("_s_tot").over(w_off), F.lit(0.0)).alias("_s_off"),
        F.coalesce(F.sum("_n_tot").over(w_off), F.lit(0)).alias("_n_off"))
    out = inner.join(offs, [F.col("_chunk") == F.col("_k_chunk"), *_same(keys)])
    n = F.col("_n_in") + F.col("_n_off")
    s = F.when(n > 0, F.coalesce(F.col("_s_in"), F.lit(0.0)) + F.col("_s_off"))
    out = out.withColumns({count_col: F.col("_c_in") + F.col("_c_off"), sum_col: s})
    if mean_col:
        out = out.withColumn(mean_col, F.when(n > 0, s / n))
    return out.drop("_part", "_at", "_chunk", "_k_chunk", "_c_in", "_c_off", "_s_in", "_s_off", "_n_in", "_n_off",
                    *[f"_k_{k}" for k in keys])


def row_index(df: DataFrame, order: Sequence[str], *, name: str = "row_idx") -> DataFrame:
    """Global 0-based position in ``order`` (a total order), computed without
    a single-partition window."""
    return _positions(lay_down(df, list(order))).withColumn(name, F.col("_pos")).drop("_pos", "_total")


# W3 ----------------------------------------------------------------------------
def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   cols: Sequence[str] | None = None) -> DataFrame:
    """Latest row per key by ``order`` (what repeated upserts leave behind).

    ``max_by`` is an aggregate, so it combines map-side before the shuffle:
    a hot key costs one partial row per task, not all its rows in one task.
    """
    keys = list(keys)
    cols = [c for c in (cols or df.columns) if c not in keys]
    ordkey = F.struct(*[F.col(c) for c in order])
    latest = F.max_by(F.struct(*[F.col(c) for c in cols]), ordkey).alias("_latest")
    return df.groupBy(*keys).agg(latest).select(*keys, "_latest.*")


# W4 ----------------------------------------------------------------------------
def leave_n_out(df: DataFrame, user: str, order: Sequence[str], start: int, stop: int,
                max_test: int = 0, *, flag: str = "is_test", **kw) -> DataFrame:
    """Per user, rows number ``start``..``stop`` (1-based, in ``order``) go to
    the test side, until ``max_test`` test rows exist overall (<= 0: no cap).

    Both counters are prefix sums: the per-user number and the global number
    of candidate rows, each computed with ``running_stats``.
    """
    numbered = running_stats(df, [user], order, None, count_col="_k", **kw)
    cand = (F.col("_k") >= start) & (F.col("_k") <= stop)
    numbered = numbered.withColumn("_cand", cand.cast("int"))
    if max_test and max_test > 0:
        # global number of candidate rows so far, in the same order
        ranked = running_stats(numbered, [], order, "_cand", sum_col="_g", mean_col=None,
                               count_col="_all", **kw)
        hit = (F.col("_cand") == 1) & (F.col("_g") <= F.lit(float(max_test)))
        return ranked.select(*df.columns, hit.alias(flag))
    return numbered.select(*df.columns, (F.col("_cand") == 1).alias(flag))


# W5 ----------------------------------------------------------------------------
def contiguous_kfold(df: DataFrame, order: Sequence[str], k: int, *, fold_col: str = "fold") -> DataFrame:
    """Fold i (1..k) = the i-th contiguous block of about N/k rows in ``order``.

    The rows lie written in order, so reading one fold or all of them again runs
    none of the plan behind ``df``.
    """
    fold = (F.floor(F.col("_pos") * F.lit(k) / F.col("_total")) + F.lit(1)).cast("int")
    return _positions(lay_down(df, list(order))).withColumn(fold_col, fold).drop("_pos", "_total")
