"""Aggregations.

All of these aggregate with a map-side partial step (hash aggregates for
counts and sums; sort aggregates when a ``max_by`` buffer holds strings),
so a key holding a third of the rows contributes one partial row per input
task to the shuffle.  No aggregate here collects rows into a list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _latest_attrs(attrs: Sequence[str], order: Sequence[str] | None) -> list[Column]:
    """Latest value of each attribute by ``order`` (or any value, if the
    attributes are functionally dependent on the key)."""
    if not attrs:
        return []
    if order:
        packed = F.max_by(F.struct(*[F.col(a) for a in attrs]),
                          F.struct(*[F.col(o) for o in order])).alias("_attrs")
    else:
        packed = F.max(F.struct(*[F.col(a) for a in attrs])).alias("_attrs")
    return [packed]


# A1 ----------------------------------------------------------------------------
def item_stats(df: DataFrame, item: str = "item_id", rating: str = "rating",
               attrs: Sequence[str] = (), order: Sequence[str] | None = None, *,
               per_pair_latest: bool = False, user: str = "user_id") -> DataFrame:
    """Per item: rating_count, rating_avg and the latest ``attrs``.

    By default every rating event counts (the reference's meaning, Q7).  With
    ``per_pair_latest`` a re-review replaces the user's earlier rating of the
    item: only the latest rating per (user, item) by ``order`` counts."""
    if per_pair_latest:
        if not order:
            raise ValueError("per_pair_latest needs an order")
        from ratecraft.operators.windows import latest_per_key
        keep = [c for c in dict.fromkeys([rating, *attrs, *order]) if c not in (user, item)]
        df = latest_per_key(df, [user, item], order, keep)
    aggs = [F.count(rating).alias("rating_count"), F.avg(F.col(rating).cast("double")).alias("rating_avg")]
    aggs += _latest_attrs(attrs, order)
    out = df.groupBy(item).agg(*aggs)
    if attrs:
        out = out.select(item, *[F.col(f"_attrs.{a}").alias(a) for a in attrs],
                         "rating_count", "rating_avg")
    return out


def item_stats_enriched(ratings: DataFrame, items: DataFrame, users: DataFrame,
                        item: str = "item_id", user: str = "user_id", rating: str = "rating",
                        item_attrs: Sequence[str] = ("title",)) -> DataFrame:
    """A1 over ratings ⋈ items ⋈ users, planned aggregate-first: ratings of
    known users (semi join, no row growth) are hash-aggregated per item, and
    only the per-item rows meet the item attributes.  The same result as
    grouping the fully joined rows, with one row per item in the last join."""
    known = ratings.join(users.select(user), user, "left_semi")
    stats = known.groupBy(item).agg(F.count(rating).alias("rating_count"),
                                    F.avg(F.col(rating).cast("double")).alias("rating_avg"))
    return stats.join(items.select(item, *item_attrs), item, "inner").select(
        item, *item_attrs, "rating_count", "rating_avg")


# A2 ----------------------------------------------------------------------------
def user_activity(df: DataFrame, user: str = "user_id", attrs: Sequence[str] = (),
                  order: Sequence[str] | None = None) -> DataFrame:
    """Per user: activity_count (events) and the latest ``attrs``."""
    aggs = [F.count(F.lit(1)).alias("activity_count")] + _latest_attrs(attrs, order)
    out = df.groupBy(user).agg(*aggs)
    if attrs:
        out = out.select(user, *[F.col(f"_attrs.{a}").alias(a) for a in attrs], "activity_count")
    return out


def user_activity_profile(ratings: DataFrame, users: DataFrame, user: str = "user_id",
                          attrs: Sequence[str] = ("age", "gender", "occupation")) -> DataFrame:
    """A2 with the profile taken from the user table, aggregate-first: counts
    per user (hash aggregate), then one join row per user."""
    counts = ratings.groupBy(user).agg(F.count(F.lit(1)).alias("activity_count"))
    return counts.join(users.select(user, *attrs), user, "inner").select(user, *attrs, "activity_count")


# A3 ----------------------------------------------------------------------------
def page_totals(df: DataFrame, per_page: int = 10) -> DataFrame:
    """Total rows and pages = ceil(n / per_page); per_page must be >= 1 (Q13)."""
    if per_page < 1:
        raise ValueError("per_page must be >= 1")
    n = F.count(F.lit(1))
    return df.agg(n.alias("total_items"),
                  F.ceil(n / F.lit(per_page)).cast("long").alias("total_pages"))


# A4 ----------------------------------------------------------------------------
def distinct_counts(df: DataFrame, cols: Sequence[str], approx_rsd: float | None = None) -> DataFrame:
    """Distinct count per column: exact (a two-phase aggregate each), or with
    ``approx_rsd`` a HyperLogLog++ sketch (one pass, fixed memory per column)."""
    if approx_rsd:
        return df.agg(*[F.approx_count_distinct(c, approx_rsd).alias(f"distinct_{c}") for c in cols])
    return df.agg(*[F.count_distinct(c).alias(f"distinct_{c}") for c in cols])


# A5 ----------------------------------------------------------------------------
def control_totals(ratings: DataFrame, declared: DataFrame, user: str = "user_id",
                   item: str = "item_id") -> DataFrame:
    """Actual (users, items, ratings) against a declared-totals table
    ``(what string, declared long)``; one row per measure with ``ok``."""
    actual = ratings.agg(F.count_distinct(user).alias("users"),
                         F.count_distinct(item).alias("items"),
                         F.count(F.lit(1)).alias("ratings"))
    return compare_totals(actual, declared)


def compare_totals(actual: DataFrame, declared: DataFrame) -> DataFrame:
    """(what, declared, actual, ok) of one row (users, items, ratings) and a table (what, declared)."""
    long = actual.select(F.explode(F.array(
        *[F.struct(F.lit(w).alias("what"), F.col(w).cast("long").alias("actual"))
          for w in ("users", "items", "ratings")])).alias("m")).select("m.*")
    j = long.join(declared, "what", "full")
    return j.select("what", "declared", "actual",
                    F.coalesce(F.col("declared") == F.col("actual"), F.lit(False)).alias("ok"))


# A6 ----------------------------------------------------------------------------
def regression_metrics(df: DataFrame, label: str = "rating",
                       prediction: str = "prediction") -> DataFrame:
    """rmse, mse, mae, r2 and the row count, in one pass (rows with a null
    prediction, i.e. cold-start drops, are excluded and counted)."""
    y = F.col(label).cast("double")
    p = F.col(prediction).cast("double")
    ok = p.isNotNull() & y.isNotNull()
    err = F.when(ok, y - p)
    yy = F.when(ok, y)
    n = F.count(err)
    sse = F.sum(err * err)
    mse = sse / n
    sst = F.sum(yy * yy) - F.sum(yy) * F.sum(yy) / n
    return df.agg(F.sqrt(mse).alias("rmse"), mse.alias("mse"),
                  (F.sum(F.abs(err)) / n).alias("mae"),
                  (F.lit(1.0) - sse / sst).alias("r2"),
                  n.alias("n_predicted"), F.count(F.lit(1)).alias("n_rows"))


# A7 ----------------------------------------------------------------------------
def min_activity(df: DataFrame, user: str = "user_id", minimum: int = 20) -> DataFrame:
    """Every user with the number of ratings and whether it is at least ``minimum``."""
    counts = df.groupBy(user).agg(F.count(F.lit(1)).alias("n_ratings"))
    return counts.withColumn("meets_minimum", F.col("n_ratings") >= minimum)


def min_activity_violations(df: DataFrame, user: str = "user_id", minimum: int = 20) -> DataFrame:
    """Users with fewer than ``minimum`` ratings, with their count."""
    return min_activity(df, user, minimum).filter(~F.col("meets_minimum")).drop("meets_minimum")


# A8 ----------------------------------------------------------------------------
def rollup_counts(df: DataFrame, key: str, value: str) -> DataFrame:
    """One batch rolled up to (key, n, s)."""
    v = F.col(value).cast("double")
    return df.groupBy(key).agg(F.count(v).alias("n"), F.sum(v).alias("s"))


def merge_counts(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Merge two (key, n, s) tables: n1+n2, s1+s2, mean = s/n; a null key is one key."""
    j = a.alias("a").join(b.alias("b"), F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}")), "full")
    n = F.coalesce(F.col("a.n"), F.lit(0)) + F.coalesce(F.col("b.n"), F.lit(0))
    s = F.coalesce(F.col("a.s"), F.lit(0.0)) + F.coalesce(F.col("b.s"), F.lit(0.0))
    return j.select(F.coalesce(F.col(f"a.{key}"), F.col(f"b.{key}")).alias(key),
                    n.alias("n"), s.alias("s"))


def counts_to_stats(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, F.col("n").alias("rating_count"),
                     F.when(F.col("n") > 0, F.col("s") / F.col("n")).alias("rating_avg"))
