"""Stream-equals-batch, restart and replay idempotence, quarantine (§5 item 3)."""

import json

import pytest
from pyspark.sql import functions as F

from ratecraft.operators import aggregates as A
from ratecraft.operators import windows as W
from ratecraft.streaming import fanout as P
from ratecraft.streaming import stateful as ST
from ratecraft.streaming.keyed import LatestTable


def _record(seq, user, movie, rating, title="T", genres=("Drama",)):
    return json.dumps({"user": {"userId": str(user), "age": "30", "gender": "F", "occupation": "x"},
                       "movie": {"movieId": str(movie), "title": title, "genres": list(genres)},
                       "rating": str(rating), "timestamp": str(880000000 + seq), "seq": str(seq)})


def _messages(spark, n=400):
    rows = [(i, _record(i, i % 13, 0 if i % 3 == 0 else i % 7, 1 + i % 5)) for i in range(n)]
    return spark.createDataFrame(rows, "seq long, json string").select(
        "seq", F.col("json").cast("binary").alias("value"))


def running(spark, tmp):
    return {r.seq: (r.item_id, r.rating_count, round(r.rating_avg, 9)) for r in spark.read.parquet(f"{tmp}/run").collect()}


def expected_running(parsed):
    rows = W.running_stats(parsed, ["item_id"], ["seq"], "rating").collect()
    return {r.seq: (r.item_id, r.run_count, round(r.run_mean, 9)) for r in rows}


def write_slices(msgs, n, path):
    """Message files in ``n`` contiguous slices, one file each, oldest first."""
    folded = W.contiguous_kfold(msgs, ["seq"], n)
    for i in range(1, n + 1):
        folded.filter(F.col("fold") == i).drop("fold").coalesce(1).write.parquet(f"{path}/slice={i:06d}")
    return [f"{path}/slice={i:06d}" for i in range(1, n + 1)]


@pytest.mark.parametrize("n_slices", [1, 2, 7])
def test_stream_equals_batch(spark, tmp, n_slices):
    msgs = _messages(spark)
    write_slices(msgs, n_slices, f"{tmp}/in")
    tables = P.RatingTables(spark, f"{tmp}/out")
    P.drain(P.start_rating_stream(P.message_stream(spark, f"{tmp}/in", max_files_per_trigger=1), tables, f"{tmp}/ck"))
    parsed, _ = P.split_quarantine(P.parse_messages(msgs))
    exp = {r.item_id: (r.rating_count, r.rating_avg) for r in A.item_stats(parsed).collect()}
    got = {r.item_id: (r.rating_count, r.rating_avg) for r in tables.item_stats().collect()}
    assert got.keys() == exp.keys()
    assert all(got[k][0] == exp[k][0] and abs(got[k][1] - exp[k][1]) < 1e-9 for k in exp)
    P.drain(ST.start_running_values(P.message_stream(spark, f"{tmp}/in", max_files_per_trigger=1), f"{tmp}/run",
                                    f"{tmp}/ck2"))
    assert running(spark, tmp) == expected_running(parsed)


def test_two_events_of_one_movie_in_one_batch_both_count(spark, tmp):
    rows = [(0, _record(0, 1, 9, 5)), (1, _record(1, 2, 9, 1))]
    msgs = spark.createDataFrame(rows, "seq long, json string").select(F.col("json").cast("binary").alias("value"))
    tables = P.RatingTables(spark, f"{tmp}/out")
    P.process_batch(tables, msgs, 0)
    r = tables.item_stats().first()
    assert (r.rating_count, r.rating_avg) == (2, 3.0)  # Q3: no lost update


def test_replayed_batch_is_idempotent(spark, tmp):
    msgs = _messages(spark, 60)
    tables = P.RatingTables(spark, f"{tmp}/out")
    P.process_batch(tables, msgs, 0)
    first = sorted(tables.item_stats().collect())
    P.process_batch(tables, msgs, 0)  # the same batch again (retry)
    assert sorted(tables.item_stats().collect()) == first


def test_bad_records_are_quarantined(spark, tmp):
    title = "It's a \"quoted\" café title"
    good = _record(1, 1, 2, 4, title=title)
    cases = [good,
             _record(2, 1, 2, "abc", title=title),                      # non-numeric rating
             "this is not json",                           # garbage
             json.dumps({"user": None, "movie": {"movieId": "3"}, "rating": "4"}),
             json.dumps({**json.loads(_record(3, 4, 5, 3)), "extra": 1}),   # extra field is fine
             json.dumps({**json.loads(_record(4, 4, 6, 3)), "movie": {"movieId": "6", "title": None,
                                                                      "genres": []}})]
    df = spark.createDataFrame([(c,) for c in cases] + [(None,)], "v string").select(
        F.col("v").cast("binary").alias("value"))
    tables = P.RatingTables(spark, f"{tmp}/out")
    P.process_batch(tables, df, 0)
    assert tables.quarantined().count() == 3
    assert tables.user_stats().agg(F.sum("activity_count")).first()[0] == 4  # the bad rating is an activity
    assert tables.review_table().count() == 3  # of user 1 and movie 2 one
    assert {r.item_id: r.rating_count for r in tables.item_stats().collect()}[2] == 1
    titles = {r.item_id: r.title for r in tables.item_stats().collect()}
    assert titles == {2: title, 5: "T", 6: None}


def test_restart_from_checkpoint_processes_only_new_slices(spark, tmp):
    msgs = _messages(spark, 200)
    staged = write_slices(msgs, 4, f"{tmp}/staged")
    tables = P.RatingTables(spark, f"{tmp}/out")
    for p in staged[:2]:
        spark.read.parquet(p).write.parquet(f"{tmp}/in/{p.rsplit('/', 1)[1]}")
    P.drain(P.start_rating_stream(P.message_stream(spark, f"{tmp}/in", max_files_per_trigger=1), tables, f"{tmp}/ck"))
    for p in staged[2:]:
        spark.read.parquet(p).write.parquet(f"{tmp}/in/{p.rsplit('/', 1)[1]}")
    P.drain(P.start_rating_stream(P.message_stream(spark, f"{tmp}/in", max_files_per_trigger=1), tables, f"{tmp}/ck"))
    total = tables.item_stats().agg(F.sum("rating_count")).first()[0]
    assert total == 200
    assert spark.read.parquet(tables.movies.changes_path).select("batch_id").distinct().count() == 4


def test_upsert_and_replay(spark, tmp):
    t = LatestTable(spark, tmp, ["k"], ["seq"])
    t.write_batch(spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], "k long, seq long, v string"), 1)
    t.write_batch(spark.createDataFrame([(1, 3, "c"), (2, 0, "old")], "k long, seq long, v string"), 2)
    t.write_batch(spark.createDataFrame([(2, 4, "d")], "k long, seq long, v string"), 3)
    t.write_batch(spark.createDataFrame([(2, 4, "d")], "k long, seq long, v string"), 3)  # replay
    assert {r.k: r.v for r in t.current().collect()} == {1: "c", 2: "d"}
    assert {r.k: r.v for r in t.current(before=3).collect()} == {1: "c", 2: "b"}  # event order, not arrival


def test_late_batch_counts_when_it_comes(spark, tmp):
    msgs = _messages(spark, 40)
    tables = P.RatingTables(spark, f"{tmp}/out")
    P.process_batch(tables, msgs.filter("seq >= 20").select("value"), 0)
    P.process_batch(tables, msgs.filter("seq < 20").select("value"), 1)
    assert tables.item_stats().agg(F.sum("rating_count")).first()[0] == 40


def test_late_event_has_a_running_row_when_it_comes(spark, tmp):
    msgs = _messages(spark, 40)
    for i, part in enumerate(("seq >= 20", "seq < 20")):  # the second start resumes from the checkpoint
        msgs.filter(part).select("value").write.parquet(f"{tmp}/in/slice={i}")
        P.drain(ST.start_running_values(P.message_stream(spark, f"{tmp}/in"), f"{tmp}/run", f"{tmp}/ck"))
    got = running(spark, tmp)
    parsed, _ = P.split_quarantine(P.parse_messages(msgs))
    assert len(got) == 40 and got[20] == expected_running(parsed.where("seq >= 20"))[20]
    totals = {}
    for item, n, _ in got.values():
        totals[item] = max(totals.get(item, 0), n)
    assert totals == {r.item_id: r.rating_count for r in A.item_stats(parsed).collect()}
    last = max((s for s in got if s < 20 and got[s][0] == 0))  # arrives last of its item
    assert got[last][1] == totals[0]


def test_running_values_cost_the_same_in_every_batch(spark, tmp):
    """Twenty micro-batches: the state holds a row an item, and a batch reads its own events only."""
    msgs = _messages(spark, 600)
    write_slices(msgs, 20, f"{tmp}/in")
    query = ST.start_running_values(P.message_stream(spark, f"{tmp}/in", max_files_per_trigger=1), f"{tmp}/run", f"{tmp}/ck")
    P.drain(query)
    batches = [p for p in query.recentProgress if p["numInputRows"]]
    assert len(batches) == 20 and {p["numInputRows"] for p in batches} == {30}
    assert {p["stateOperators"][0]["numRowsTotal"] for p in batches} == {7}
    assert len(running(spark, tmp)) == 600


def test_unfinished_batch_is_not_seen(spark, tmp):
    msgs = _messages(spark, 40)
    tables = P.RatingTables(spark, f"{tmp}/out")
    P.process_batch(tables, msgs.filter("seq < 20").select("value"), 0)
    parsed, _ = P.split_quarantine(P.parse_messages(msgs.filter("seq >= 20")))
    tables.movies.write_batch(parsed.groupBy("item_id").agg(
        F.count("rating").alias("n"), F.sum("rating").alias("s"), F.max("title").alias("title"),
        F.max("genres").alias("genres"), F.max("ts").alias("ts"), F.max("seq").alias("seq")), 1)  # no marker
    assert tables.item_stats().agg(F.sum("rating_count")).first()[0] == 20


def test_unreadable_timestamp_has_a_running_row(spark, tmp):
    bad = json.dumps({**json.loads(_record(1, 2, 9, 1)), "timestamp": "soon"})
    no_seq = json.dumps({k: v for k, v in json.loads(_record(2, 3, 9, 3)).items() if k != "seq"})
    df = spark.createDataFrame([(_record(0, 1, 9, 5),), (bad,), (no_seq,)], "v string").select(
        F.col("v").cast("binary").alias("value"))
    df.coalesce(1).write.parquet(f"{tmp}/in")
    P.drain(ST.start_running_values(P.message_stream(spark, f"{tmp}/in"), f"{tmp}/run", f"{tmp}/ck"))
    assert running(spark, tmp) == {1: (9, 1, 1.0), 0: (9, 2, 3.0), None: (9, 3, 3.0)}


def test_per_pair_latest_option(spark, tmp):
    rows = [(0, _record(0, 1, 9, 5)), (1, _record(1, 2, 9, 1)), (2, _record(2, 1, 9, 3))]  # user 1 re-reviews
    msgs = spark.createDataFrame(rows, "seq long, json string").select(F.col("json").cast("binary").alias("value"))
    tables = P.RatingTables(spark, f"{tmp}/out")
    P.process_batch(tables, msgs, 0)
    events = tables.item_stats().first()
    latest = tables.item_stats_latest_reviews().first()
    assert (events.rating_count, events.rating_avg) == (3, 3.0)      # every event counts (Q7 default)
    assert (latest.rating_count, latest.rating_avg) == (2, 2.0)      # re-review replaces
    parsed, _ = P.split_quarantine(P.parse_messages(msgs))
    b = A.item_stats(parsed, order=["seq"], per_pair_latest=True).first()
    assert (b.rating_count, b.rating_avg) == (2, 2.0)


def test_string_ids(spark, tmp):
    rows = [(0, _record(0, "u-1", "m-9", 5)), (1, _record(1, "u-2", "m-9", 1)), (2, _record(2, "u-1", "007", 3))]
    msgs = spark.createDataFrame(rows, "seq long, json string").select(F.col("json").cast("binary").alias("value"))
    tables = P.RatingTables(spark, f"{tmp}/out", id_type="string")
    P.process_batch(tables, msgs, 0)
    assert tables.quarantined().count() == 0
    assert {r.item_id: (r.rating_count, r.rating_avg) for r in tables.item_stats().collect()} == {
        "m-9": (2, 3.0), "007": (1, 3.0)}
    assert {r.user_id: r.activity_count for r in tables.user_stats().collect()} == {"u-1": 2, "u-2": 1}
    assert {r.item_id for r in tables.item_stats_latest_reviews().collect()} == {"m-9", "007"}
    as_numbers = P.RatingTables(spark, f"{tmp}/numbers")
    P.process_batch(as_numbers, msgs, 0)
    assert as_numbers.quarantined().count() == 3


def test_pages_are_replayed_once_over_stops_and_restarts(spark, tmp):
    """Three starts of one micro-batch each, then none; a running stream takes a step per trigger."""
    from ratecraft.operators.paging import PageIndex
    from ratecraft.sources.page_stream import page_stream
    index = PageIndex.build(_messages(spark, 300), ["seq"], f"{tmp}/pages", parts=5)
    tables = P.RatingTables(spark, f"{tmp}/out")
    offsets = []
    for _ in range(4):
        stream = page_stream(PageIndex(spark, f"{tmp}/pages"), 10, 12).select("value")
        query = P.start_rating_stream(stream, tables, f"{tmp}/ck")
        P.drain(query)
        offsets += [(p["numInputRows"], p["sources"][0]["endOffset"]) for p in query.recentProgress if p["numInputRows"]]
    assert offsets == [(120, "{'page': 12}"), (120, "{'page': 24}"), (60, "{'page': 30}")]
    parsed, _ = P.split_quarantine(P.parse_messages(_messages(spark, 300)))
    want = {r.item_id: r.rating_count for r in A.item_stats(parsed).collect()}
    assert {r.item_id: r.rating_count for r in tables.item_stats().collect()} == want
    query = (page_stream(index, 10, 12).writeStream.format("parquet").option("path", f"{tmp}/rows")
             .option("checkpointLocation", f"{tmp}/ck2").trigger(processingTime="200 milliseconds").start())
    try:
        query.processAllAvailable()
        assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [120, 120, 60]
    finally:
        query.stop()
    assert sorted(r.seq for r in spark.read.parquet(f"{tmp}/rows").collect()) == list(range(300))


def test_kafka_gets_the_callers_options_only():
    class Reader:
        def __init__(self):
            self.seen = {}

        def format(self, name):
            self.seen["format"] = name
            return self

        def options(self, **kw):
            self.seen["options"] = kw
            return self

        def load(self):
            return self

        def select(self, c):
            self.seen["select"] = c
            return self

    class Session:
        readStream = Reader()

    given = {"kafka.bootstrap.servers": "host:1", "subscribe": "topic"}
    assert P.message_stream(Session, fmt="kafka", options=given).seen == {
        "format": "kafka", "options": given, "select": "value"}


def test_good_fields_survive_bad_ones(spark):
    """Records printed as literals, records with a missing or wrong field, and text that is no record."""
    user = {"userId": "7", "age": "30", "gender": "F", "occupation": "x"}
    movie = {"movieId": "9", "title": "It's \"quoted\" \\ caf\u00e9, None: True\u00a0", "genres": ["Drama", "Sci-Fi"]}
    whole = {"user": user, "movie": movie, "rating": "4", "timestamp": "880000000"}

    def read(text):
        df = spark.createDataFrame([(text,)], "v string").select(F.col("v").cast("binary").alias("value"))
        return P.parse_messages(df).drop("raw").first()

    good = read(json.dumps(whole))
    assert (good.item_id, good.user_id, good.rating, good.title, good.genres) == (9, 7, 4.0, movie["title"], movie["genres"])
    assert read(str(whole)) == good                                        # printed, with an escaped character
    no_title = read(str({**whole, "movie": {**movie, "title": None}}))     # a None nulls itself only
    assert no_title.title is None and no_title.asDict() == {**good.asDict(), "title": None}
    first_bad = read(json.dumps({"movie": "gone", **{k: v for k, v in whole.items() if k != "movie"}}))
    assert first_bad.item_id is None and (first_bad.user_id, first_bad.rating, first_bad.age) == (7, 4.0, 30)
    odd = read(json.dumps({**whole, "user": {**user, "age": ["?"]}, "movie": {**movie, "genres": "Drama"}}))
    assert odd.age is None and odd.genres is None and (odd.item_id, odd.user_id, odd.title) == (9, 7, movie["title"])
    assert read(json.dumps({**whole, "user": {**user, "age": 30, "userId": 7}})) == good  # numbers read as text
    assert set(read("{'user': ").asDict().values()) == set(read("").asDict().values()) == {None}


def test_batches_are_counted_by_their_jobs(spark, tmp):
    msgs = _messages(spark, 50).select("value")
    tables = P.RatingTables(spark, f"{tmp}/out")
    assert tables.batches().count() == 0
    P.process_batch(tables, msgs.union(spark.createDataFrame([(b"no record",)], "value binary")), 0)
    P.process_batch(tables, msgs.limit(0), 1)
    assert sorted(tuple(r) for r in tables.batches().collect()) == [(0, 51, 1), (1, 0, 0)]


def test_state_is_read_back_from_the_checkpoint(spark, tmp):
    msgs = _messages(spark, 200)
    write_slices(msgs, 2, f"{tmp}/in")
    P.drain(ST.start_state_store_counts(P.message_stream(spark, f"{tmp}/in", max_files_per_trigger=1), f"{tmp}/out",
                                        f"{tmp}/ck").query)
    state = ST.read_counts(spark, f"{tmp}/ck")
    want = {r.item_id: (r.rating_count, r.rating_avg) for r in A.item_stats(
        P.split_quarantine(P.parse_messages(msgs))[0]).collect()}
    assert {r.item_id: (r.rating_count, r.rating_avg) for r in state.collect()} == want
    assert [r.rating_count for r in state.where("item_id = 0").collect()] == [want[0][0]]
    assert state.where("item_id = 999").count() == 0


def test_rows_of_a_trigger_are_dealt_to_tasks_by_number(spark):
    """Two files, three tasks' worth of rows in one of them: the file does not bound the tasks."""
    from ratecraft.sources.page_stream import TASK_ROWS, _PageReader
    big = 3 * TASK_ROWS
    reader = _PageReader("unused", None, [[0, 0, 7], [1, 7, big]], 10, big)
    runs = reader.partitions({"page": 0}, {"page": -(-(big + 7) // 10)})
    assert max(r.hi - r.lo for r in runs) <= TASK_ROWS
    assert [(r.part, r.lo, r.hi) for r in runs] == [(0, 0, 7)] + [(1, k * TASK_ROWS, (k + 1) * TASK_ROWS) for k in range(3)]


def test_a_message_is_parsed_once_not_once_a_field(spark):
    rows = spark.range(3).select(F.col("id").cast("string").cast("binary").alias("value"))
    plan = P.parse_messages(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.lower().replace("_", "").count("parsejson") <= 2  # as JSON, and as a printed literal
