"""Joins.

No join here carries a hard ``broadcast()`` hint on data that grows with
the input: with AQE on, Spark converts a sort-merge join into a broadcast
join only after the shuffle has measured the small side against
``spark.sql.adaptive.autoBroadcastJoinThreshold``, and splits skewed
partitions of the big side otherwise.  That is the size check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# J1 + J2 -----------------------------------------------------------------------
def enrich_ratings(ratings: DataFrame, items: DataFrame, users: DataFrame,
                   item: str = "item_id", user: str = "user_id",
                   item_cols: Sequence[str] = ("title",),
                   user_cols: Sequence[str] = ("age", "gender", "occupation")) -> DataFrame:
    """ratings ⋈ items on item, then ⋈ users on user (inner, like the page service)."""
    it = items.select(item, *item_cols)
    us = users.select(user, *user_cols)
    return ratings.join(it, item, "inner").join(us, user, "inner")


# J3 ----------------------------------------------------------------------------
def lookup_with_default(events: DataFrame, state: DataFrame, key: str,
                        defaults: dict[str, object]) -> DataFrame:
    """Each event joined to the stored aggregate of its key; a key not yet in
    the store gets ``defaults`` (0 for counters, as the reference does)."""
    cols = list(defaults)
    st = state.select(F.col(key).alias("_lk_key"), *cols)
    j = events.join(st, events[key] == st["_lk_key"], "left").drop("_lk_key")
    for c, d in defaults.items():
        j = j.withColumn(c, F.coalesce(F.col(c), F.lit(d)))
    return j


# J6 ----------------------------------------------------------------------------
def reviewers(reviews: DataFrame, item: str = "item_id", user: str = "user_id") -> DataFrame:
    """Distinct (item, user) reviewer pairs."""
    return reviews.select(item, user).distinct()


# J4 ----------------------------------------------------------------------------
def reviewers_with_activity(reviews: DataFrame, activity: DataFrame, item: str = "item_id",
                            user: str = "user_id") -> DataFrame:
    """Reviewers of each item joined to their activity count (one join
    instead of one lookup per reviewer)."""
    return reviewers(reviews, item, user).join(activity.select(user, "activity_count"), user, "inner")


# J5 ----------------------------------------------------------------------------
def keep_known(ids: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """ids ⋉ table: ids that exist in the table (semi join, no duplication)."""
    return ids.join(table.select(key), key, "left_semi")


# P16 ---------------------------------------------------------------------------
def keep_listed(df: DataFrame, key: str, values: Sequence) -> DataFrame:
    """Rows whose ``key`` is among ``values``, a short list the caller holds: a filter that
    reaches the file scan.  Nulls match nothing, an empty list keeps no row.  A list of ids
    that lies in a table goes through ``keep_known``."""
    return df.filter(F.col(key).isin([v for v in values if v is not None]))


# J7 ----------------------------------------------------------------------------
def complement(all_rows: DataFrame, part: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``all_rows`` whose key is not in ``part`` (train = all - test)."""
    cond = [all_rows[k].eqNullSafe(part[k]) for k in keys]
    return all_rows.join(part.select(*keys), cond, "left_anti")
