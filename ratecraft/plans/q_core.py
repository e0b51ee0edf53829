"""Registered queries: sources, projections, joins, aggregates, sets, top-k."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratecraft.functions import columns as C
from ratecraft.operators import aggregates as A
from ratecraft.operators import bitmaps as B
from ratecraft.operators import fingerprint as FP
from ratecraft.operators import joins as J
from ratecraft.operators import topk as TK
from ratecraft.operators import windows as W
from ratecraft.plans.catalog import query
from ratecraft.plans.pages import page_index, page_response, titles
from ratecraft.schemas import create_table_if_absent, drop_table, mapping_to_schema
from ratecraft.session import work_dir
from ratecraft.sources import files as FS
from ratecraft.sources.bucketed import buckets_for, write_bucketed
from ratecraft.sources.observed import write_observed
from ratecraft.sources.tables import (EVENTS_SQL, ITEM_GENRES, ITEMS_SQL, RATING_ORDER,
                                      RATINGS_SQL, USERS_SQL, events_view, items_view,
                                      ratings_view, table, users_view)

R, E, I, U = RATINGS_SQL, EVENTS_SQL, ITEMS_SQL, USERS_SQL
ENR = (f"(SELECT r.user_id, r.item_id, r.rating, r.ts, i.title, u.age, u.gender, u.occupation "
       f"FROM {R} r JOIN {I} i ON r.item_id = i.item_id JOIN {U} u ON r.user_id = u.user_id)")
GENRES_SQL = ("concat_ws(',', " + ", ".join(f"CASE WHEN \"{g}\" = 1 THEN '{g}' END" for g in ITEM_GENRES) + ")")
GENRES_LIST_SQL = ("list_filter([" + ", ".join(f"CASE WHEN \"{g}\" = 1 THEN '{g}' END" for g in ITEM_GENRES)
                   + "], lambda x: x IS NOT NULL)")
EPOCH = "CAST(epoch(ts) AS BIGINT)"


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    return J.enrich_ratings(ratings_view(spark, sf), items_view(spark, sf), users_view(spark, sf))


def genres_col() -> F.Column:
    return C.one_hot_to_array(ITEM_GENRES, ITEM_GENRES)


def epoch_seconds(c: str = "ts") -> F.Column:
    return F.unix_seconds(F.col(c).cast("timestamp"))


# --- flagship: J1 + J2 + A1 --------------------------------------------------------
@query("A1_item_stats_enriched", f"""
SELECT item_id, title, count(rating) AS rating_count, avg(rating) AS rating_avg
FROM {ENR} GROUP BY item_id, title""")
def a1_item_stats_enriched(spark, sf):
    return A.item_stats_enriched(ratings_view(spark, sf), items_view(spark, sf), users_view(spark, sf))


@query("J1_J2_enrich_ratings", f"SELECT user_id, item_id, rating, ts, title, age, gender, occupation FROM {ENR}")
def j1_j2(spark, sf):
    return enriched(spark, sf).select("user_id", "item_id", "rating", "ts", "title", "age",
                                      "gender", "occupation")


# --- sources ------------------------------------------------------------------------
@query("S1_read_ratings_tsv", f"""
SELECT CAST(user_id AS INTEGER) AS user_id, CAST(item_id AS INTEGER) AS item_id,
       CAST(rating AS FLOAT) AS rating, CAST({EPOCH} AS INTEGER) AS timestamp FROM {R}""")
def s1(spark, sf):
    r = ratings_view(spark, sf).select("user_id", "item_id", "rating",
                                       epoch_seconds().alias("timestamp"))
    path = FS.write_delimited(r, work_dir(spark, "s1") + "/ratings", "\t")
    return FS.read_ratings(spark, path)


@query("S2_read_items_pipe_latin1", f"""
SELECT CAST(item_id AS INTEGER) AS item_id, title, brand AS url, {GENRES_SQL} AS genres_text
FROM {I}""")
def s2(spark, sf):
    it = items_view(spark, sf)
    flat = it.select("item_id", "title", F.lit(None).cast("string").alias("release_date"),
                     F.lit(None).cast("string").alias("video_release_date"),
                     F.col("brand").alias("url"), *ITEM_GENRES)
    path = FS.write_delimited(flat, work_dir(spark, "s2") + "/items", "|", "ISO-8859-1")
    got = FS.read_items(spark, path, ITEM_GENRES)
    return got.select("item_id", "title", "url", F.array_join("genres", ",").alias("genres_text"))


@query("S3_read_users_pipe", f"""
SELECT CAST(user_id AS INTEGER) AS user_id, CAST(age AS INTEGER) AS age, gender, occupation, zipcode
FROM {U}""")
def s3(spark, sf):
    path = FS.write_delimited(users_view(spark, sf), work_dir(spark, "s3") + "/users", "|")
    return FS.read_users(spark, path)


@query("S4_read_lookup_list", """
SELECT name, CAST(row_number() OVER (ORDER BY name) - 1 AS INTEGER) AS idx
FROM (SELECT DISTINCT p_type AS name FROM part)""")
def s4(spark, sf):
    names = table(spark, sf, "part").select(F.col("p_type").alias("name")).distinct()
    # the list is small (one row per distinct type); an index over it is a
    # single sorted partition of a handful of rows
    lst = names.select("name", (F.row_number().over(Window.orderBy("name")) - 1).alias("idx"))
    # one trailing blank line, as lookup files carry (a global aggregate: one row)
    blank = names.agg(F.max(F.lit("")).alias("name"), F.max(F.lit(None).cast("int")).alias("idx"))
    path = FS.write_delimited(lst.unionByName(blank), work_dir(spark, "s4") + "/lookup", "|")
    return FS.read_lookup(spark, path)


@query("S5_U1_read_folds_as_one", f"""
SELECT CAST(user_id AS INTEGER) AS user_id, CAST(item_id AS INTEGER) AS item_id,
       CAST(rating AS FLOAT) AS rating, CAST(seq AS INTEGER) AS timestamp FROM {E}""")
def s5(spark, sf):
    folded = W.contiguous_kfold(events_view(spark, sf), ["seq"], 5)
    path = work_dir(spark, "s5") + "/u"
    rows = folded.select("user_id", "item_id", "rating", F.col("seq").alias("timestamp"), "fold")
    if rows.isEmpty():  # no folds: one empty file
        return FS.read_ratings(spark, FS.write_delimited(rows.drop("fold"), path, "\t"))
    FS.write_delimited(rows, path, "\t", by=["fold"])  # a folder per fold, as the published files, in one job
    return TK.union_all([FS.read_ratings(spark, f"{path}/fold={i}") for i in range(1, 6)])


@query("S10_P14_point_read_state", f"""
WITH s AS (SELECT item_id, count(rating) AS rating_count, avg(rating) AS rating_avg FROM {E} GROUP BY item_id),
top AS (SELECT item_id FROM s ORDER BY rating_count DESC, item_id ASC LIMIT 1)
SELECT s.* FROM s JOIN top USING (item_id)""")
def s10(spark, sf):
    state = A.item_stats(events_view(spark, sf))
    path = work_dir(spark, "s10") + "/item_stats"
    state.write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    best = TK.top_k(stored, [F.desc("rating_count"), F.asc("item_id")], 1).first()
    key = best["item_id"] if best else None
    return stored.filter(F.col("item_id") == F.lit(key))  # pushed to the Parquet scan


@query("S11_scan_titles", "SELECT p_partkey AS item_id, p_name AS title FROM part")
def s11(spark, sf):
    return titles(items_view(spark, sf))


@query("S11_first_25_titles", "SELECT p_partkey AS item_id, p_name AS title FROM part ORDER BY p_partkey LIMIT 25")
def s11_limit(spark, sf):
    """The limit argument of the title scan."""
    return titles(items_view(spark, sf), limit=25)


# The item table as a mapping declares it.
ITEM_MAPPING = {"mappings": {"properties": {
    "movieId": {"type": "keyword"}, "title": {"type": "text"}, "brand": {"type": "keyword"},
    "genres": {"type": "text", "fields": {"keyword": {"type": "keyword"}}}}}}


def _filled_table(spark, sf) -> str:
    """A table made from the mapping, twice, with the rows of the items."""
    name = f"items_{uuid.uuid4().hex[:12]}"
    schema = mapping_to_schema(ITEM_MAPPING)
    where = work_dir(spark, "k4") + "/items"
    create_table_if_absent(spark, name, schema, where)
    it = items_view(spark, sf).select(F.col("item_id").cast("string"), "title", "brand", genres_col())
    it.write.insertInto(name)
    create_table_if_absent(spark, name, schema, where)  # leaves the rows as they are
    return name


@query("K4_create_table_from_mapping", f"""
SELECT CAST(item_id AS VARCHAR) AS movieId, title, brand, array_to_string({GENRES_LIST_SQL}, ',') AS genres_text FROM {I}""")
def k4(spark, sf):
    got = spark.table(_filled_table(spark, sf))
    return got.withColumn("genres_text", F.array_join("genres", ",")).drop("genres")


@query("K5_drop_table", "SELECT count(*) AS rows_before, true AS gone, true AS gone_again FROM part")
def k5(spark, sf):
    name = _filled_table(spark, sf)
    rows = spark.table(name).count()
    first, second = drop_table(spark, name), drop_table(spark, name)
    return spark.range(1).select(F.lit(rows).cast("long").alias("rows_before"), F.lit(first).alias("gone"),
                                 F.lit(second).alias("gone_again"))


# --- projections --------------------------------------------------------------------
@query("P1_one_hot_to_genres", f"SELECT item_id, {GENRES_SQL} AS genres_text, CAST(len({GENRES_LIST_SQL}) AS INTEGER) AS n_genres FROM {I}")
def p1(spark, sf):
    g = genres_col()
    return items_view(spark, sf).select("item_id", F.array_join(g, ",").alias("genres_text"),
                                        F.size(g).alias("n_genres"))


def _nested_records(spark, sf) -> DataFrame:
    items = items_view(spark, sf).withColumn("genres", genres_col())
    e = J.enrich_ratings(ratings_view(spark, sf), items, users_view(spark, sf), item_cols=("title", "genres"))
    rec = C.nest_record(
        user={"userId": "user_id", "age": "age", "gender": "gender", "occupation": "occupation"},
        movie={"movieId": "item_id", "title": "title", "genres": "genres"},
        rating="rating", timestamp=epoch_seconds())
    return e.select(rec.alias("record"))


NESTED_FLAT_SQL = f"""
SELECT CAST(item_id AS VARCHAR) AS movieId, title, array_to_string(genres, ',') AS genres_text,
       CAST(rating AS VARCHAR) AS rating, CAST({EPOCH} AS VARCHAR) AS timestamp,
       CAST(user_id AS VARCHAR) AS userId, CAST(age AS VARCHAR) AS age, gender, occupation
FROM (SELECT e.*, {GENRES_LIST_SQL} AS genres FROM {ENR} e JOIN {I} i USING (item_id))"""


@query("P2_P3_P4_P5_P6_nest_json_roundtrip", NESTED_FLAT_SQL)
def p2_p6(spark, sf):
    from ratecraft.schemas import EVENT_SCHEMA
    payload = C.to_payload(_nested_records(spark, sf))           # bytes, as a message value
    text = payload.select(C.payload_text("value").alias("json"))  # P3
    parsed = text.select(C.parse_json("json", EVENT_SCHEMA).alias("data")).select("data.*")  # P4 + P5
    flat = parsed.select("movie.*", "rating", "timestamp", "user.*")  # P6
    return flat.select("movieId", "title", F.array_join("genres", ",").alias("genres_text"),
                       "rating", "timestamp", "userId", "age", "gender", "occupation")


@query("T2_A3_K7_page_response", f"""
WITH e AS (SELECT r.user_id, r.item_id, r.rating, r.ts, i.title, u.age, u.gender, u.occupation,
                  r.l_orderkey, r.l_linenumber, r.l_suppkey, r.l_quantity, r.l_extendedprice,
                  r.l_discount, r.l_tax, r.l_returnflag, r.l_linestatus, {GENRES_LIST_SQL} AS genres
           FROM {R} r JOIN {I} i ON r.item_id = i.item_id JOIN {U} u ON r.user_id = u.user_id),
p AS (SELECT *, row_number() OVER (ORDER BY {'user_id, item_id, ts, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus'}) - 1 AS pos FROM e)
SELECT CAST(7 AS BIGINT) AS page, CAST(ceil((SELECT count(*) FROM e) / 10) AS BIGINT) AS total_pages, pos - 60 + 1 AS position,
       json_object('user', json_object('userId', CAST(user_id AS VARCHAR), 'age', CAST(age AS VARCHAR),
                                        'gender', gender, 'occupation', occupation),
                   'movie', json_object('movieId', CAST(item_id AS VARCHAR), 'title', title, 'genres', genres),
                   'rating', CAST(rating AS VARCHAR), 'timestamp', CAST({EPOCH} AS VARCHAR))::VARCHAR AS json
FROM p WHERE pos >= 60 AND pos < 70""")
def t2_page_response(spark, sf):
    """Page 7 (10 per page) of the page service: records in total order."""
    us = users_view(spark, sf).select("user_id", "age", "gender", "occupation")
    r = ratings_view(spark, sf, with_order=True, users=us)
    it = items_view(spark, sf).select("item_id", "title", genres_col().alias("genres"))
    e = r.join(it, "item_id")
    rec = C.nest_record(
        user={"userId": "user_id", "age": "age", "gender": "gender", "occupation": "occupation"},
        movie={"movieId": "item_id", "title": "title", "genres": "genres"},
        rating="rating", timestamp=epoch_seconds())
    return page_response(page_index(e, PAGE_ORDER, rec), page=7, per_page=10)


@query("K7_json_records", f"""
SELECT json_object('user', json_object('userId', CAST(user_id AS VARCHAR), 'age', CAST(age AS VARCHAR),
                                        'gender', gender, 'occupation', occupation),
                   'movie', json_object('movieId', CAST(item_id AS VARCHAR), 'title', title, 'genres', genres),
                   'rating', CAST(rating AS VARCHAR), 'timestamp', CAST({EPOCH} AS VARCHAR))::VARCHAR AS json
FROM (SELECT e.*, {GENRES_LIST_SQL} AS genres FROM {ENR} e JOIN {I} i USING (item_id))""")
def k7(spark, sf):
    return FS.to_json_lines(_nested_records(spark, sf))


@query("P7_review_key", f"SELECT CAST(user_id AS VARCHAR) || '_' || CAST(item_id AS VARCHAR) AS review_id, user_id, item_id, rating FROM {R}")
def p7(spark, sf):
    r = ratings_view(spark, sf)
    return r.select(C.composite_key("user_id", "item_id").alias("review_id"), "user_id", "item_id", "rating")


@query("P8_epoch_seconds_to_date", f"SELECT user_id, item_id, {EPOCH} AS epoch_s, CAST(ts AS DATE) AS day FROM {R}")
def p8(spark, sf):
    r = ratings_view(spark, sf).select("user_id", "item_id", epoch_seconds().alias("epoch_s"))
    return r.select("user_id", "item_id", "epoch_s", C.epoch_to_date("epoch_s").alias("day"))


@query("P9_multi_format_timestamp", f"""
SELECT seq, CASE seq % 3 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('day', ts)
                          ELSE date_trunc('millisecond', ts) END AS parsed_ts
FROM {E}""")
def p9(spark, sf):
    ev = events_view(spark, sf)
    txt = (F.when(F.col("seq") % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
           .when(F.col("seq") % 3 == 1, F.date_format("ts", "yyyy-MM-dd"))
           .otherwise(F.unix_millis(F.col("ts").cast("timestamp")).cast("string")))
    return ev.select("seq", C.parse_multi_format_ts(txt).cast("timestamp_ntz").alias("parsed_ts"))


@query("P13_safe_casts", f"""
SELECT seq, TRY_CAST(CAST(item_id AS VARCHAR) AS INTEGER) AS item_int,
       TRY_CAST(event_type AS INTEGER) AS type_int, TRY_CAST(CAST(rating AS VARCHAR) AS DOUBLE) AS rating_d
FROM {E}""")
def p13(spark, sf):
    ev = events_view(spark, sf)
    return ev.select("seq", C.safe_cast(F.col("item_id").cast("string"), "int").alias("item_int"),
                     C.safe_cast("event_type", "int").alias("type_int"),
                     C.safe_cast(F.col("rating").cast("string"), "double").alias("rating_d"))


@query("P15_nested_key_equality", f"""
WITH top AS (SELECT item_id FROM {R} GROUP BY item_id ORDER BY count(*) DESC, item_id LIMIT 1)
SELECT CAST(user_id AS VARCHAR) || '_' || CAST(item_id AS VARCHAR) AS review_id,
       CAST(user_id AS VARCHAR) AS userId, CAST(item_id AS VARCHAR) AS movieId, rating
FROM {R} WHERE item_id = (SELECT item_id FROM top)""")
def p15(spark, sf):
    r = ratings_view(spark, sf)
    reviews = r.select(C.composite_key("user_id", "item_id").alias("review_id"),
                       F.struct(F.col("user_id").cast("string").alias("userId")).alias("user"),
                       F.struct(F.col("item_id").cast("string").alias("movieId")).alias("movie"),
                       "rating")
    path = work_dir(spark, "p15") + "/reviews"
    reviews.write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    hot = TK.top_k(r.groupBy("item_id").count(), [F.desc("count"), F.asc("item_id")], 1).first()
    key = F.lit(str(hot["item_id"]) if hot else None)  # no ratings: no key, no rows
    hit = stored.filter(F.col("movie.movieId") == key)
    return hit.select("review_id", "user.userId", "movie.movieId", "rating")


@query("P16_J5_in_list_semi_join", f"SELECT item_id, title FROM {I} WHERE item_id IN (SELECT item_id FROM {E})")
def p16(spark, sf):
    ids = events_view(spark, sf).select("item_id")
    return J.keep_known(items_view(spark, sf), ids, "item_id").select("item_id", "title")


@query("P16_short_list_of_ids", f"""
WITH top AS (SELECT item_id FROM {E} GROUP BY item_id ORDER BY count(*) DESC, item_id LIMIT 10)
SELECT item_id, title FROM {I} WHERE item_id IN (SELECT item_id FROM top)""")
def p16_list(spark, sf):
    """The ten most rated items by a list of ids, pushed to the scan."""
    counts = events_view(spark, sf).groupBy("item_id").count()
    ids = [r.item_id for r in TK.top_k(counts, [F.desc("count"), F.asc("item_id")], 10).collect()]
    return J.keep_listed(items_view(spark, sf), "item_id", ids).select("item_id", "title")


@query("P17_P18_display_cards", f"""
SELECT s.item_id, array_to_string({GENRES_LIST_SQL}, ', ') AS genres_display,
       printf('%.2f', s.rating_avg + CASE WHEN s.rating_avg * 8 = floor(s.rating_avg * 8) THEN 0.001 ELSE 0 END) AS avg_display,
       s.rating_avg >= 4.0 AS highlight
FROM (SELECT item_id, avg(rating) AS rating_avg FROM {E} GROUP BY item_id) s
JOIN {I} i ON s.item_id = i.item_id""")
def p17_p18(spark, sf):
    st = A.item_stats(events_view(spark, sf))
    it = items_view(spark, sf).select("item_id", genres_col().alias("genres"))
    j = st.join(it, "item_id")
    return j.select("item_id", C.genre_text("genres").alias("genres_display"),
                    C.two_decimals("rating_avg").alias("avg_display"),
                    C.highlight("rating_avg").alias("highlight"))


CAP_SQL = ("list_aggregate(list_transform(string_split(s, ' '), lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), "
           "'string_agg', ' ') || ' '")


@query("P19_capitalize_words", f"""
SELECT id, {CAP_SQL.replace('s,', 'name,')} AS name_cap FROM (
  SELECT p_partkey AS id, p_name AS name FROM part UNION ALL
  SELECT c_custkey + 1000000000 AS id, lower(c_mktsegment || '  ' || c_name) AS name FROM customer)""")
def p19(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    c = table(spark, sf, "customer").select(
        (F.col("c_custkey") + 1000000000).alias("id"),
        F.lower(F.concat("c_mktsegment", F.lit("  "), "c_name")).alias("name"))
    return p.unionByName(c).select("id", C.capitalize_words("name").alias("name_cap"))


@query("F2_capitalize_pandas_udf", f"""
SELECT p_partkey AS id, {CAP_SQL.replace('s,', 'p_name,')} AS name_cap FROM part""")
def f2(spark, sf):
    from ratecraft.functions.udfs import capitalize_words_udf
    p = table(spark, sf, "part")
    return p.select(F.col("p_partkey").alias("id"), capitalize_words_udf("p_name").alias("name_cap"))


# --- joins ----------------------------------------------------------------------------
FOLD2_E = f"(SELECT *, CAST(floor((row_number() OVER (ORDER BY seq) - 1) * 2 / count(*) OVER ()) + 1 AS INTEGER) AS fold FROM {E})"


@query("J3_lookup_missing_is_zero", f"""
WITH f AS {FOLD2_E},
st AS (SELECT item_id, count(rating) AS rating_count_old, avg(rating) AS rating_avg_old FROM f WHERE fold = 1 GROUP BY item_id)
SELECT f.seq, f.item_id, coalesce(st.rating_count_old, 0) AS rating_count_old,
       coalesce(st.rating_avg_old, 0.0) AS rating_avg_old
FROM f LEFT JOIN st ON f.item_id = st.item_id WHERE f.fold = 2""")
def j3(spark, sf):
    f = W.contiguous_kfold(events_view(spark, sf), ["seq"], 2)
    st = A.item_stats(f.filter("fold = 1")).select(
        "item_id", F.col("rating_count").alias("rating_count_old"), F.col("rating_avg").alias("rating_avg_old"))
    ev = f.filter("fold = 2").select("seq", "item_id")
    return J.lookup_with_default(ev, st, "item_id", {"rating_count_old": 0, "rating_avg_old": 0.0})


@query("J4_reviewers_with_activity", f"""
WITH act AS (SELECT user_id, count(*) AS activity_count FROM {R} GROUP BY user_id)
SELECT DISTINCT r.item_id, r.user_id, a.activity_count FROM {R} r JOIN act a ON r.user_id = a.user_id""")
def j4(spark, sf):
    r = ratings_view(spark, sf)
    return J.reviewers_with_activity(r, A.user_activity(r)).select("item_id", "user_id", "activity_count")


@query("J6_distinct_reviewers_per_item", f"SELECT item_id, count(DISTINCT user_id) AS n_reviewers FROM {R} GROUP BY item_id")
def j6(spark, sf):
    return J.reviewers(ratings_view(spark, sf)).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_reviewers"))


# --- aggregates -----------------------------------------------------------------------------
@query("A1_item_stats_latest_attr", f"""
SELECT item_id, arg_max(event_type, seq) AS event_type, count(rating) AS rating_count, avg(rating) AS rating_avg
FROM {E} GROUP BY item_id""")
def a1b(spark, sf):
    return A.item_stats(events_view(spark, sf), attrs=["event_type"], order=["seq"])


@query("A1_Q7_item_stats_latest_review_per_pair", f"""
SELECT item_id, count(rating) AS rating_count, avg(rating) AS rating_avg FROM (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY seq DESC) AS rn FROM {E})
  WHERE rn = 1) GROUP BY item_id""")
def a1_q7(spark, sf):
    """Decision Q7's option: a re-review replaces the earlier rating."""
    return A.item_stats(events_view(spark, sf), order=["seq"], per_pair_latest=True)


@query("A2_user_activity", f"""
SELECT user_id, arg_max(event_type, seq) AS event_type, count(*) AS activity_count FROM {E} GROUP BY user_id""")
def a2(spark, sf):
    return A.user_activity(events_view(spark, sf), attrs=["event_type"], order=["seq"])


@query("A2_user_activity_profile", f"""
SELECT r.user_id, u.age, u.gender, u.occupation, count(*) AS activity_count
FROM {R} r JOIN {U} u ON r.user_id = u.user_id GROUP BY r.user_id, u.age, u.gender, u.occupation""")
def a2b(spark, sf):
    return A.user_activity_profile(ratings_view(spark, sf), users_view(spark, sf))


@query("A3_page_totals", f"SELECT count(*) AS total_items, CAST(ceil(count(*) / 10) AS BIGINT) AS total_pages FROM {ENR}")
def a3(spark, sf):
    return A.page_totals(enriched(spark, sf), 10)


@query("A4_distinct_users_items", f"SELECT count(DISTINCT user_id) AS distinct_user_id, count(DISTINCT item_id) AS distinct_item_id FROM {R}")
def a4(spark, sf):
    return A.distinct_counts(ratings_view(spark, sf), ["user_id", "item_id"])


A5_SQL = f"""
WITH d AS (SELECT 'users' AS what, (SELECT count(*) FROM customer) AS declared
           UNION ALL SELECT 'items', (SELECT count(*) FROM part)
           UNION ALL SELECT 'ratings', (SELECT count(*) FROM lineitem)),
a AS (SELECT 'users' AS what, count(DISTINCT user_id) AS actual FROM {R}
      UNION ALL SELECT 'items', count(DISTINCT item_id) FROM {R}
      UNION ALL SELECT 'ratings', count(*) FROM {R})
SELECT coalesce(d.what, a.what) AS what, d.declared, a.actual, coalesce(d.declared = a.actual, false) AS ok
FROM d FULL JOIN a ON d.what = a.what"""


def declared_totals(spark, sf) -> DataFrame:
    """(what, declared): the rows of the three tables."""
    return TK.union_all([table(spark, sf, name).agg(F.count(F.lit(1)).alias("declared")).select(F.lit(what).alias("what"), "declared")
                         for what, name in (("users", "customer"), ("items", "part"), ("ratings", "lineitem"))])


@query("A5_control_totals", A5_SQL)
def a5(spark, sf):
    return A.control_totals(ratings_view(spark, sf), declared_totals(spark, sf))


@query("A4_distinct_ids_of_merged_batches", f"SELECT count(DISTINCT user_id) AS distinct_user_id, count(DISTINCT item_id) AS distinct_item_id FROM {R}")
def a4_merged(spark, sf):
    """Four batches, each counted by itself into stored bitmaps; the exact counts come from merging those."""
    batches = ratings_view(spark, sf, with_order=True).withColumn("batch", F.pmod(F.xxhash64("l_orderkey"), F.lit(4)))
    path = work_dir(spark, "a4") + "/bitmaps"
    stored = B.id_bitmaps(batches, ["user_id", "item_id"], ["batch"])
    stored.write.partitionBy("batch").parquet(path)
    return B.distinct_ids(spark.read.schema(stored.schema).parquet(path), ["user_id", "item_id"])


@query("A3_page_totals_while_writing", f"SELECT count(*) AS total_items, CAST(ceil(count(*) / 10) AS BIGINT) AS total_pages FROM {ENR}")
def a3_written(spark, sf):
    """The job that writes the records counts them."""
    path = work_dir(spark, "a3") + "/records"
    seen = write_observed(_nested_records(spark, sf), lambda df: FS.write_json(df, path, "gzip"),
                          n=F.count(F.lit(1)))
    return spark.createDataFrame([(seen["n"], -(-seen["n"] // 10))], "total_items long, total_pages long")


@query("A5_control_totals_while_writing", A5_SQL)
def a5_written(spark, sf):
    """Ratings counted by the job that stores the id bitmaps, users and items from the bitmaps."""
    path = work_dir(spark, "a5") + "/bitmaps"
    seen = write_observed(ratings_view(spark, sf), lambda df: B.id_bitmaps(df, ["user_id", "item_id"]).write.parquet(path),
                          n=F.count(F.lit(1)))
    ids = B.distinct_ids(spark.read.parquet(path), ["user_id", "item_id"])
    actual = ids.select(F.col("distinct_user_id").alias("users"), F.col("distinct_item_id").alias("items"),
                        F.lit(seen["n"]).cast("long").alias("ratings"))
    return A.compare_totals(actual, declared_totals(spark, sf))


@query("J4_A2_reviewers_on_bucketed_tables", f"""
WITH act AS (SELECT user_id, count(*) AS activity_count FROM {R} GROUP BY user_id)
SELECT DISTINCT r.item_id, r.user_id, a.activity_count, u.occupation
FROM {R} r JOIN act a ON r.user_id = a.user_id JOIN {U} u ON r.user_id = u.user_id""")
def j4_bucketed(spark, sf):
    """Ratings and users lie in buckets of the user: counting, both joins and DISTINCT need no shuffle."""
    n = buckets_for(table(spark, sf, "lineitem").count())
    r = write_bucketed(ratings_view(spark, sf).select("user_id", "item_id"), ["user_id"], n)
    u = write_bucketed(users_view(spark, sf).select("user_id", "occupation"), ["user_id"], n)
    return J.reviewers_with_activity(r, A.user_activity(r)).join(u, "user_id").select(
        "item_id", "user_id", "activity_count", "occupation")


@query("J1_J2_enrich_bucketed", f"SELECT user_id, item_id, rating, ts, title, age, gender, occupation FROM {ENR}")
def j1_bucketed(spark, sf):
    """Ratings joined to items where both lie, then laid out by user for the join with users."""
    n = buckets_for(table(spark, sf, "lineitem").count())
    r = write_bucketed(ratings_view(spark, sf), ["item_id"], n)
    i = write_bucketed(items_view(spark, sf).select("item_id", "title"), ["item_id"], n)
    by_user = write_bucketed(r.join(i, "item_id"), ["user_id"], n)
    u = write_bucketed(users_view(spark, sf).select("user_id", "age", "gender", "occupation"), ["user_id"], n)
    return by_user.join(u, "user_id").select("user_id", "item_id", "rating", "ts", "title", "age", "gender", "occupation")


@query("A7_min_activity_invariant", f"""
SELECT user_id, count(*) AS n_ratings, count(*) >= 20 AS meets_minimum FROM {R} GROUP BY user_id""")
def a7(spark, sf):
    return A.min_activity(ratings_view(spark, sf), minimum=20)


@query("A8_merge_batch_rollups", f"""
SELECT item_id, count(rating) AS rating_count, avg(rating) AS rating_avg FROM {E} GROUP BY item_id""")
def a8(spark, sf):
    f = W.contiguous_kfold(events_view(spark, sf), ["seq"], 2)
    a = A.rollup_counts(f.filter("fold = 1"), "item_id", "rating")
    b = A.rollup_counts(f.filter("fold = 2"), "item_id", "rating")
    return A.counts_to_stats(A.merge_counts(a, b, "item_id"), "item_id")


# --- top-k / paging ---------------------------------------------------------------------------
@query("T1_top10_active_reviewers_per_item", f"""
WITH act AS (SELECT user_id, count(*) AS activity_count FROM {R} GROUP BY user_id),
rv AS (SELECT DISTINCT r.item_id, r.user_id, a.activity_count FROM {R} r JOIN act a USING (user_id))
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY activity_count DESC, user_id) AS rank FROM rv)
WHERE rank <= 10""")
def t1(spark, sf):
    r = ratings_view(spark, sf)
    rv = J.reviewers_with_activity(r, A.user_activity(r))
    return TK.top_k_per_group(rv, ["item_id"], [F.desc("activity_count"), F.asc("user_id")], 10).select(
        "item_id", "user_id", "activity_count", F.col("rank").cast("long").alias("rank"))


ENR_ORDER_SQL = "user_id, item_id, ts, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
PAGE_ORDER = ["user_id", "item_id"] + [c for c in RATING_ORDER if c != "item_id"]


@query("T2_page_7_of_10", f"""
SELECT user_id, item_id, rating, ts FROM (
  SELECT *, row_number() OVER (ORDER BY {ENR_ORDER_SQL}) - 1 AS pos FROM {R}) WHERE pos >= 60 AND pos < 70""")
def t2(spark, sf):
    r = ratings_view(spark, sf, with_order=True)
    return TK.paginate(r, PAGE_ORDER, page=7, per_page=10).select("user_id", "item_id", "rating", "ts")


@query("T2_page_numbers", f"""
SELECT user_id, item_id, ts, l_orderkey, l_linenumber, pos AS position, CAST(floor(pos / 10) + 1 AS BIGINT) AS page FROM (
  SELECT *, row_number() OVER (ORDER BY {ENR_ORDER_SQL}) - 1 AS pos FROM {R})""")
def t2b(spark, sf):
    r = ratings_view(spark, sf, with_order=True)
    return TK.page_numbers(r, PAGE_ORDER, 10).select("user_id", "item_id", "ts", "l_orderkey",
                                                     "l_linenumber", "position", "page")


LATEST_PAIR_SQL = f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, item_id
   ORDER BY ts DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
            l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM {R}) WHERE rn = 1)"""


def latest_reviews(spark, sf) -> DataFrame:
    """The latest rating of each (user, item).  Most of the order only tells rows of one order apart, which the join
    with the orders has brought together: they are settled there, so the next shuffle takes ts and order key only."""
    r = ratings_view(spark, sf, with_order=True)
    per_order = W.latest_per_key(r, ["l_orderkey", "user_id", "item_id"], RATING_ORDER, ["rating", "ts"])
    return W.latest_per_key(per_order, ["user_id", "item_id"], ["ts", "l_orderkey"], ["rating", "ts"])


@query("T3_top3_items_per_user", f"""
SELECT user_id, CAST(rank AS BIGINT) AS rank, item_id, rating FROM (
  SELECT user_id, item_id, rating, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, ts DESC, item_id) AS rank
  FROM {LATEST_PAIR_SQL}) WHERE rank <= 3""")
def t3(spark, sf):
    lr = latest_reviews(spark, sf)
    top = TK.top_k_per_group(lr, ["user_id"], [F.desc("rating"), F.desc("ts"), F.asc("item_id")], 3)
    return top.select("user_id", F.col("rank").cast("long").alias("rank"), "item_id", "rating")


@query("P20_T3_explode_topn_arrays", f"""
SELECT user_id, item_id, rating FROM (
  SELECT user_id, item_id, rating, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, ts DESC, item_id) AS rank
  FROM {LATEST_PAIR_SQL}) WHERE rank <= 3""")
def p20(spark, sf):
    lr = latest_reviews(spark, sf)
    arrs = TK.top_k_arrays(lr, "user_id", [F.desc("rating"), F.desc("ts"), F.asc("item_id")], 3,
                           ["item_id", "rating"])
    return C.explode_recommendations(arrs)


@query("U4_distinct_recommended_items", f"""
SELECT DISTINCT item_id FROM (
  SELECT item_id, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, ts DESC, item_id) AS rank
  FROM {LATEST_PAIR_SQL}) WHERE rank <= 3""")
def u4(spark, sf):
    lr = latest_reviews(spark, sf)
    arrs = TK.top_k_arrays(lr, "user_id", [F.desc("rating"), F.desc("ts"), F.asc("item_id")], 3,
                           ["item_id", "rating"])
    return C.explode_recommendations(arrs).select("item_id").distinct()


@query("T5_sort_by_user_item", f"""
SELECT user_id, item_id, rating, row_number() OVER (ORDER BY user_id, item_id, rating) - 1 AS position FROM {R}""")
def t5(spark, sf):
    """The whole table in order, each row with its place in it."""
    order = ["user_id", "item_id", "rating"]
    rows = ratings_view(spark, sf).select(*order)
    return W.row_index(rows, order, name="position").orderBy("position")


# --- set operations ----------------------------------------------------------------------------
FOLD5_E = f"(SELECT *, CAST(floor((row_number() OVER (ORDER BY seq) - 1) * 5 / count(*) OVER ()) + 1 AS INTEGER) AS fold FROM {E})"


@query("U2_folds_pairwise_disjoint", f"""
WITH f AS {FOLD5_E}, ids AS (SELECT DISTINCT fold FROM f)
SELECT a.fold AS part_a, b.fold AS part_b,
       (SELECT count(*) FROM f x JOIN f y ON x.seq = y.seq WHERE x.fold = a.fold AND y.fold = b.fold) AS overlap
FROM ids a JOIN ids b ON a.fold < b.fold""")
def u2(spark, sf):
    f = W.contiguous_kfold(events_view(spark, sf), ["seq"], 5)
    return B.overlap_counts(f, "fold", "seq", range(1, 6))


@query("U1_folds_make_the_whole", f"SELECT count(*) AS n_left, count(*) AS n_right, true AS same FROM {E}")
def u1(spark, sf):
    """Five fold files read back hold exactly the rows of the whole: one fingerprint, no join."""
    whole = events_view(spark, sf).select("user_id", "item_id", "rating", F.col("seq").alias("timestamp"))
    return FP.same_rows(s5(spark, sf), whole)


@query("U3_train_and_test_make_the_whole", f"SELECT count(*) AS n_left, count(*) AS n_right, true AS same FROM {E}")
def u3_whole(spark, sf):
    ev = events_view(spark, sf).select("seq", "user_id", "item_id", "rating")
    test = W.leave_n_out(ev, "user_id", ["seq"], 1, 10).filter("is_test").drop("is_test")
    return FP.same_rows(ev, TK.union_all([J.complement(ev, test, ["seq"]), test]))


@query("U3_J7_train_is_complement", f"""
WITH t AS (SELECT seq FROM (SELECT seq, row_number() OVER (PARTITION BY user_id ORDER BY seq) AS k FROM {E}) WHERE k BETWEEN 1 AND 10)
SELECT seq, user_id, item_id, rating FROM {E} WHERE seq NOT IN (SELECT seq FROM t)""")
def u3(spark, sf):
    ev = events_view(spark, sf).select("seq", "user_id", "item_id", "rating")
    test = W.leave_n_out(ev, "user_id", ["seq"], 1, 10).filter("is_test").select("seq")
    return J.complement(ev, test, ["seq"])
