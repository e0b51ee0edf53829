"""Registered queries: running statistics, latest rows, evaluation splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratecraft.functions import columns as C
from ratecraft.operators import windows as W
from ratecraft.operators.splits import hash_split
from ratecraft.plans.catalog import query
from ratecraft.plans.q_core import LATEST_PAIR_SQL, latest_reviews
from ratecraft.sources.tables import EVENTS_SQL, events_view

E = EVENTS_SQL
RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
PREV = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


@query("W1_running_item_stats", f"""
SELECT seq, item_id, count(*) OVER (PARTITION BY item_id ORDER BY seq {RUN}) AS rating_count,
       avg(rating) OVER (PARTITION BY item_id ORDER BY seq {RUN}) AS rating_avg
FROM {E}""")
def w1(spark, sf):
    ev = events_view(spark, sf)
    r = W.running_stats(ev, ["item_id"], ["seq"], "rating")
    return r.select("seq", "item_id", F.col("run_count").alias("rating_count"),
                    F.col("run_mean").alias("rating_avg"))


@query("P10_P11_incremental_update", f"""
SELECT seq, item_id, coalesce(old_n, 0) + 1 AS rating_count,
       (coalesce(old_avg, 0.0) * coalesce(old_n, 0) + rating) / (coalesce(old_n, 0) + 1.0) AS rating_avg
FROM (SELECT seq, item_id, rating,
             count(*) OVER (PARTITION BY item_id ORDER BY seq {PREV}) AS old_n,
             avg(rating) OVER (PARTITION BY item_id ORDER BY seq {PREV}) AS old_avg FROM {E})""")
def p10_p11(spark, sf):
    """The row the stream job emits per event: the stored state before the
    event (count, mean) updated with the event's rating."""
    ev = events_view(spark, sf)
    r = W.running_stats(ev, ["item_id"], ["seq"], "rating")
    old_n = F.col("run_count") - 1
    old_avg = F.when(old_n > 0, (F.col("run_sum") - F.col("rating")) / old_n)
    return r.select("seq", "item_id", C.increment(old_n).alias("rating_count"),
                    C.incremental_mean(old_avg, old_n, "rating").alias("rating_avg"))


@query("W2_running_user_activity", f"""
SELECT seq, user_id, count(*) OVER (PARTITION BY user_id ORDER BY seq {RUN}) AS activity_count FROM {E}""")
def w2(spark, sf):
    r = W.running_stats(events_view(spark, sf), ["user_id"], ["seq"])
    return r.select("seq", "user_id", F.col("run_count").alias("activity_count"))


@query("W3_latest_review_per_pair", f"SELECT user_id, item_id, rating, ts FROM {LATEST_PAIR_SQL}")
def w3(spark, sf):
    return latest_reviews(spark, sf)


@query("W4_leave_10_out", f"""
SELECT seq, user_id, k BETWEEN 1 AND 10 AS is_test FROM (
  SELECT seq, user_id, row_number() OVER (PARTITION BY user_id ORDER BY seq) AS k FROM {E})""")
def w4(spark, sf):
    ev = events_view(spark, sf).select("seq", "user_id")
    return W.leave_n_out(ev, "user_id", ["seq"], 1, 10, 0)


@query("W4_leave_11_20_out_capped", f"""
SELECT seq, user_id, cand AND sum(CAST(cand AS INTEGER)) OVER (ORDER BY seq {RUN}) <= 1000 AS is_test FROM (
  SELECT seq, user_id, row_number() OVER (PARTITION BY user_id ORDER BY seq) BETWEEN 11 AND 20 AS cand FROM {E})""")
def w4b(spark, sf):
    ev = events_view(spark, sf).select("seq", "user_id")
    return W.leave_n_out(ev, "user_id", ["seq"], 11, 20, 1000)


@query("W5_contiguous_5_folds", f"""
SELECT seq, CAST(floor((row_number() OVER (ORDER BY seq) - 1) * 5 / count(*) OVER ()) + 1 AS INTEGER) AS fold FROM {E}""")
def w5(spark, sf):
    return W.contiguous_kfold(events_view(spark, sf).select("seq"), ["seq"], 5)


@query("M1_hash_split_disjoint_complete", f"SELECT seq, CAST(1 AS BIGINT) AS n_sides FROM {E}")
def m1_hash(spark, sf):
    """Every row lands in exactly one side; sides are stable under
    repartitioning because they depend only on the key."""
    ev = events_view(spark, sf)
    tr, te = hash_split(ev, ["seq"], 0.8, seed=42)
    both = (tr.select("seq", F.lit("train").alias("side"))
            .unionByName(te.select("seq", F.lit("test").alias("side"))))
    return both.groupBy("seq").agg(F.count("side").alias("n_sides"))
