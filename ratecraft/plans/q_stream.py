"""Registered queries: streams over the pages of the events.

Each query lays the events (joined to item and user attributes, as the page
service does) down in order as JSON message payloads behind a page index, and
replays them: a stream whose offset is the page number takes a quarter of the
pages in a micro-batch and stops, and every start but the first resumes from the
checkpoint.  The query returns a view of what the stream wrote.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ratecraft.functions import columns as C
from ratecraft.operators import topk as TK
from ratecraft.operators.paging import PageIndex
from ratecraft.operators.windows import contiguous_kfold
from ratecraft.plans.catalog import query
from ratecraft.plans.q_core import GENRES_LIST_SQL, genres_col
from ratecraft.session import work_dir
from ratecraft.sources.page_stream import page_stream
from ratecraft.sources.tables import (EVENTS_SQL, ITEMS_SQL, USERS_SQL, events_view,
                                      items_view, users_view)
from ratecraft.streaming import fanout as P
from ratecraft.streaming import stateful as ST
from ratecraft.streaming.keyed import LatestTable

PER_PAGE = 10
MIN_BATCHES, ROWS_PER_BATCH = 4, 5_000_000


EV_ENR = (f"(SELECT e.seq, e.item_id, e.user_id, e.rating, date_trunc('second', e.ts) AS ts, i.title, "
          f"array_to_string({GENRES_LIST_SQL}, ',') AS genres_text, u.age, u.gender, u.occupation "
          f"FROM {EVENTS_SQL} e JOIN {ITEMS_SQL} i ON e.item_id = i.item_id "
          f"JOIN {USERS_SQL} u ON e.user_id = u.user_id)")


def event_messages(spark, sf):
    """events ⋈ items ⋈ users as nested records (P2) carrying ``seq``."""
    ev = events_view(spark, sf)
    it = items_view(spark, sf).select("item_id", "title", genres_col().alias("genres"))
    us = users_view(spark, sf).select("user_id", "age", "gender", "occupation")
    e = ev.join(it, "item_id").join(us, "user_id")
    rec = C.nest_record(
        user={"userId": "user_id", "age": "age", "gender": "gender", "occupation": "occupation"},
        movie={"movieId": "item_id", "title": "title", "genres": "genres"},
        rating="rating", timestamp=F.unix_seconds(F.col("ts").cast("timestamp")))
    rec = F.struct(*[rec.getField(f).alias(f) for f in ("user", "movie", "rating", "timestamp")],
                   F.col("seq").cast("string").alias("seq"))
    return e.select("seq", rec.alias("record"))


def _payload(spark, sf):
    return event_messages(spark, sf).select("seq", F.to_json("record").cast("binary").alias("value"))


def _pages(spark, sf, base):
    """(index of the payloads, pages a micro-batch takes, micro-batches): four at least, of 5 million events at most."""
    index = PageIndex.build(_payload(spark, sf), ["seq"], f"{base}/in")
    pages = -(-index.total() // PER_PAGE)
    step = max(1, min(-(-pages // MIN_BATCHES), ROWS_PER_BATCH // PER_PAGE))
    return index, step, -(-pages // step)


def _replay(spark, sf, name, start, after=lambda i, index, step: None):
    """Until the pages are through: ``start(stream, base)`` a query, drain it.  Returns the base folder."""
    base = work_dir(spark, name)
    index, step, batches = _pages(spark, sf, base)
    for i in range(max(batches, 1)):
        P.drain(start(page_stream(index, PER_PAGE, step).select("value"), base))
        after(i, index, step)
    return base


def _run_rating_stream(spark, sf, name):
    base = _replay(spark, sf, name, lambda stream, base: P.start_rating_stream(
        stream, P.RatingTables(spark, f"{base}/out"), f"{base}/ckpt"))
    return P.RatingTables(spark, f"{base}/out")


@query("R1_K2_stream_movie_state", f"""
SELECT item_id, any_value(title) AS title, any_value(genres_text) AS genres_text,
       count(*) AS rating_count, avg(rating) AS rating_avg FROM {EV_ENR} GROUP BY item_id""")
def r1_movies(spark, sf):
    s = _run_rating_stream(spark, sf, "r1m").item_stats()
    return s.select("item_id", "title", F.array_join("genres", ",").alias("genres_text"),
                    "rating_count", "rating_avg")


@query("R1_K2_stream_user_state", f"""
SELECT user_id, any_value(age) AS age, any_value(gender) AS gender, any_value(occupation) AS occupation,
       count(*) AS activity_count FROM {EV_ENR} GROUP BY user_id""")
def r1_users(spark, sf):
    return _run_rating_stream(spark, sf, "r1u").user_stats()


@query("R5_K1_stream_reviews_latest", f"""
SELECT review_id, rating, ts, seq FROM (
  SELECT CAST(user_id AS VARCHAR) || '_' || CAST(item_id AS VARCHAR) AS review_id, rating, ts, seq,
         row_number() OVER (PARTITION BY user_id, item_id ORDER BY seq DESC) AS rn FROM {EV_ENR}) WHERE rn = 1""")
def r5(spark, sf):
    return _run_rating_stream(spark, sf, "r5").review_table().select("review_id", "rating", "ts", "seq")


@query("R3_stream_running_item_stats", f"""
SELECT seq, item_id, count(*) OVER w AS rating_count, avg(rating) OVER w AS rating_avg
FROM {EV_ENR} WINDOW w AS (PARTITION BY item_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def r3(spark, sf):
    """(n, sum) per item in the state store, resumed from the checkpoint for every micro-batch."""
    base = _replay(spark, sf, "r3", lambda stream, base: ST.start_running_values(stream, f"{base}/out", f"{base}/ckpt"))
    return spark.read.parquet(f"{base}/out")


@query("R4_R7_restart_and_replay_idempotent", f"""
SELECT item_id, count(*) AS rating_count, avg(rating) AS rating_avg FROM {EV_ENR} GROUP BY item_id""")
def r4(spark, sf):
    """Stop after every micro-batch, re-run an already committed one (as a retry
    after a lost executor would), restart from the checkpoint for the next:
    the movie state equals one clean pass."""
    def tables(base):
        return P.RatingTables(spark, f"{base}/out")

    def start(stream, base):
        return P.start_rating_stream(stream, tables(base), f"{base}/ckpt")

    def again(i, index, step):
        if i == 1:  # the second batch processed once more from its pages
            rows = step * PER_PAGE
            P.process_batch(tables(index.path.rsplit("/", 1)[0]), index.slice(rows, 2 * rows).select("value"), 1)

    return tables(_replay(spark, sf, "r4", start, again)).item_stats().select("item_id", "rating_count", "rating_avg")


@query("R2_state_store_item_stats", f"""
SELECT item_id, count(*) AS rating_count, avg(rating) AS rating_avg FROM {EV_ENR} GROUP BY item_id""")
def r2(spark, sf):
    """The same per-movie state kept by Spark's state store (update mode),
    upserted into a keyed table each batch."""
    base = _replay(spark, sf, "r2", lambda stream, base: ST.start_state_store_counts(
        stream, f"{base}/out", f"{base}/ckpt").query)
    return ST.counts_table(spark, f"{base}/out").current().select("item_id", "rating_count", "rating_avg")


def _state(spark, sf, name):
    base = _replay(spark, sf, name, lambda stream, base: ST.start_state_store_counts(
        stream, f"{base}/out", f"{base}/ckpt").query)
    return ST.read_counts(spark, f"{base}/ckpt")


@query("S10_read_state_store", f"""
SELECT item_id, count(*) AS rating_count, avg(rating) AS rating_avg FROM {EV_ENR} GROUP BY item_id""")
def s10_state(spark, sf):
    """The live state of the keyed stream, read from its checkpoint."""
    return _state(spark, sf, "s10s")


@query("S10_point_read_state_store", f"""
WITH s AS (SELECT item_id, count(*) AS rating_count FROM {EV_ENR} GROUP BY item_id)
SELECT item_id, rating_count FROM s ORDER BY rating_count DESC, item_id LIMIT 1""")
def s10_state_key(spark, sf):
    """One key of the live state: that of the most rated item."""
    state = _state(spark, sf, "s10k")
    rated = event_messages(spark, sf).groupBy(F.col("record.movie.movieId").cast("long").alias("item_id")).count()
    top = TK.top_k(rated, [F.desc("count"), F.asc("item_id")], 1).first()
    return state.where(F.col("item_id") == F.lit(top["item_id"] if top else None)).select("item_id", "rating_count")


@query("R1_Q5_batch_totals", f"SELECT count(*) AS n_messages, CAST(0 AS BIGINT) AS n_quarantined FROM {EV_ENR}")
def r1_totals(spark, sf):
    """Messages and quarantined records of all batches, counted by the jobs that wrote them."""
    done = _run_rating_stream(spark, sf, "r1t").batches()
    return done.agg(F.coalesce(F.sum("n_messages"), F.lit(0)).alias("n_messages"),
                    F.coalesce(F.sum("n_quarantined"), F.lit(0)).alias("n_quarantined"))


def _to_files(stream, base):
    return (stream.writeStream.format("parquet").option("path", f"{base}/out").outputMode("append")
            .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())


@query("K3_memory_sink_flatten", f"""
SELECT CAST(item_id AS VARCHAR) AS movieId, title, genres_text, CAST(rating AS VARCHAR) AS rating,
       CAST(user_id AS VARCHAR) AS userId, CAST(age AS VARCHAR) AS age, gender, occupation FROM {EV_ENR}""")
def k3(spark, sf):
    base = _replay(spark, sf, "k3", lambda stream, base: _to_files(ST.flatten_stream(stream), base))
    got = spark.read.parquet(f"{base}/out")
    return got.select("movieId", "title", F.array_join("genres", ",").alias("genres_text"), "rating",
                      "userId", "age", "gender", "occupation")


@query("S7_S9_R8_replay_all_rows_once", f"SELECT seq, item_id, user_id, rating FROM {EV_ENR}")
def s9(spark, sf):
    """Pages replayed through a stream that stops after each quarter and resumes: every row arrives once."""
    base = _replay(spark, sf, "s9", lambda stream, base: _to_files(
        P.parse_messages(stream).select("seq", "item_id", "user_id", "rating"), base))
    return spark.read.parquet(f"{base}/out")


@query("W3_K1_upsert_latest_per_pair", f"""
SELECT review_id, rating, seq FROM (
  SELECT CAST(user_id AS VARCHAR) || '_' || CAST(item_id AS VARCHAR) AS review_id, rating, seq,
         row_number() OVER (PARTITION BY user_id, item_id ORDER BY seq DESC) AS rn FROM {EVENTS_SQL}) WHERE rn = 1""")
def k1(spark, sf):
    """Batch upsert: each contiguous fold of the events is one upsert batch."""
    events = events_view(spark, sf)
    n = max(MIN_BATCHES, -(-events.count() // ROWS_PER_BATCH))
    ev = contiguous_kfold(events, ["seq"], n)
    t = LatestTable(spark, work_dir(spark, "k1"), ["review_id"], ["seq"])
    rows = ev.select(C.composite_key("user_id", "item_id").alias("review_id"), "rating", "seq", "fold")
    for b in range(1, n + 1):
        t.write_batch(rows.filter(F.col("fold") == b).drop("fold"), b)
    return t.current().select("review_id", "rating", "seq")

