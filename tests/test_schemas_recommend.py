"""Mapping conversion and tables (K4/K5), ALS helpers (M2-M8), contract."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecraft import schemas as S
from ratecraft.operators import aggregates as A
from ratecraft.plans import recommend as M

MAPPING = {"settings": {"number_of_shards": 1},
           "mappings": {"properties": {
               "reviewId": {"type": "keyword"}, "rating": {"type": "float"},
               "timestamp": {"type": "date", "format": "yyyy-MM-dd||epoch_millis"},
               "movie": {"properties": {"movieId": {"type": "keyword"},
                                        "genres": {"type": "text", "fields": {"keyword": {"type": "keyword"}}},
                                        "rating_count": {"type": "integer"}}}}}}


def test_mapping_to_schema_and_tables(spark):
    sch = S.mapping_to_schema(MAPPING)
    assert sch["rating"].dataType.simpleString() == "double"
    assert sch["movie"].dataType["genres"].dataType.simpleString() == "array<string>"
    assert sch["movie"].dataType["rating_count"].dataType.simpleString() == "bigint"
    assert S.create_table_if_absent(spark, "rc_reviews", sch)
    assert S.create_table_if_absent(spark, "rc_reviews", sch)  # existing is fine
    assert S.drop_table(spark, "rc_reviews") and S.drop_table(spark, "rc_reviews")


def _planted(spark, users=150, items=90, seed=5):
    """Ratings from two hidden tastes: what a factor model finds and item means do not."""
    rnd = random.Random(seed)
    uf = [(rnd.gauss(0, 1), rnd.gauss(0, 1)) for _ in range(users)]
    itf = [(rnd.gauss(0, 1), rnd.gauss(0, 1)) for _ in range(items)]
    truth = {(u, i): 3 + uf[u][0] * itf[i][0] + uf[u][1] * itf[i][1] for u in range(users) for i in range(items)}
    rows = [(u, i, truth[u, i] + rnd.gauss(0, 0.1)) for u, i in truth if rnd.random() < 0.5]
    return truth, spark.createDataFrame(rows, "user_id long, item_id long, rating double")


def test_als_beats_the_item_mean_and_finds_the_planted_items(spark):
    from ratecraft.operators.splits import hash_split
    truth, ratings = _planted(spark)
    train, test = hash_split(M.prepare(ratings), ["user_id", "item_id"], 0.8, seed=1)
    model = M.fit_als(train, rank=4, max_iter=15, reg=0.02)
    m = M.evaluate(model, test).first()
    base = A.regression_metrics(M.baseline_predict(train, test)).first()
    assert m.n_predicted == m.n_rows and m.rmse < 0.35 < 1.0 < base.rmse
    recs = M.recommend_all(model, 5).collect()
    hits = 0
    for r in recs:
        best = sorted((i for u, i in truth if u == r.user_id), key=lambda i: -truth[r.user_id, i])[:10]
        hits += sum(x.item_id in best for x in r.recommendations)
    assert len(recs) == 150 and hits > 0.9 * 5 * 150
    users = spark.createDataFrame([(1,), (1,), (999,)], "user_id int")
    sub = M.recommend_users(model, users, 2).collect()
    assert [x.user_id for x in sub] == [1]  # duplicates collapse, unknown users vanish


def test_tuning_picks_the_point_of_the_smallest_error(spark):
    _, ratings = _planted(spark, 60, 40)
    model, table = M.tune_als(M.prepare(ratings), ranks=(1, 3), iters=(1, 8), regs=(0.02, 2.0))
    rows = {(r["rank"], r.maxIter, r.regParam): r.rmse for r in table.collect()}
    assert len(rows) == 8 and M.settings(model) == min(rows, key=rows.get) == (3, 8, 0.02)
    folded = M.prepare(ratings).withColumn("fold", (F.col("item_id") % 3 + F.col("user_id")) % 3 + 1)
    model, table = M.kfold_als(folded, ranks=(1, 3), iters=(6,), regs=(0.02, 2.0))
    rows = {(r["rank"], r.maxIter, r.regParam): r.avg_rmse for r in table.collect()}
    assert len(rows) == 4 and M.settings(model) == min(rows, key=rows.get)


@pytest.mark.parametrize("group_bytes", [1, 64 << 20])
def test_top_items_are_the_models_own_lists(spark, group_bytes):
    """All users against brute force and MLlib; lengths differ, so most pairs are never scored."""
    from ratecraft.operators.factors import top_items
    rng = np.random.default_rng(4)
    items = (rng.normal(size=(5000, 8)) * rng.lognormal(0, 1, size=(5000, 1))).astype(np.float32)
    items[100:130] = items[7]  # ties
    users = rng.normal(size=(300, 8)).astype(np.float32)
    users[5] = 0

    def frame(x):
        return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(9999, None)], "id int, features array<float>")
    got = top_items(frame(users), frame(items), 10, group_bytes).collect()
    score = users.astype(float) @ items.astype(float).T
    assert sorted(r.id for r in got) == list(range(300))
    for r in got:
        best = np.lexsort((np.arange(5000), -score[r.id]))[:10]
        assert [x["item"] for x in r.recommendations] == best.tolist()
        assert np.allclose([x["rating"] for x in r.recommendations], score[r.id, best], rtol=1e-6)
    assert sum(r.n_scored for r in got) < 0.5 * score.size
    few = top_items(frame(users), frame(items[:3]), 10).collect()
    assert all(len(r.recommendations) == 3 for r in few)
    assert all(not r.recommendations for r in top_items(frame(users), frame(items[:0]), 10).collect())


def test_lists_equal_mllib(spark):
    model = M.fit_als(M.prepare(_planted(spark)[1]), rank=6, max_iter=4, reg=0.05)
    own = {r.user_id: r.recommendations for r in M.top_n(model, 7).collect()}
    theirs = {r.user_id: r.recommendations for r in model.recommendForAllUsers(7).collect()}
    assert own.keys() == theirs.keys()
    for u, rows in theirs.items():
        assert np.allclose([x.rating for x in rows], [x.rating for x in own[u]], atol=1e-5)
        clear = min(abs(a.rating - b.rating) for a, b in zip(rows, rows[1:])) > 1e-4
        assert not clear or [x.item_id for x in rows[:-1]] == [x.item_id for x in own[u][:-1]]


def test_checked_int_rejects_out_of_range(spark):
    df = spark.createDataFrame([(2 ** 40,)], "user_id long")
    with pytest.raises(Exception):
        df.select(M.checked_int("user_id")).collect()


def test_grid_size(spark):
    from pyspark.ml.recommendation import ALS
    als = ALS()
    assert len(M.param_grid(als, [20, 30, 40], [10, 15, 20], [0.05, 0.1, 0.2])) == 27


def test_contract_keys_and_entry(spark):
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 70
    df = E.entry(spark)
    assert df.count() > 0 and set(df.columns) == {"item_id", "title", "rating_count", "rating_avg"}


def test_index_ids_dense_and_distributed(spark):
    df = spark.createDataFrame([("u-b", 1), ("u-a", 2), ("u-b", 3), ("u-c", 4)], "uid string, x int")
    out, mapping = M.index_ids(df, "uid", "user_id")
    m = {r.uid: r.user_id for r in mapping.collect()}
    assert sorted(m.values()) == [0, 1, 2] and m["u-a"] < m["u-b"] < m["u-c"]
    assert out.count() == 4 and dict(out.dtypes)["user_id"] == "int"


def test_tables_for_every_mapping_file(spark, tmp):
    import json
    for name in ("rc_movies", "rc_users"):
        with open(f"{tmp}/{name}.json", "w") as f:
            json.dump({"mappings": {"properties": {"id": {"type": "keyword"}, "n": {"type": "integer"}}}}, f)
    assert S.create_tables_from_mappings(spark, tmp) == {"rc_movies": True, "rc_users": True}
    assert S.create_tables_from_mappings(spark, tmp) == {"rc_movies": True, "rc_users": True}
    assert S.drop_tables_from_mappings(spark, tmp) == {"rc_movies": True, "rc_users": True}


def test_approx_distinct_close_to_exact(spark):
    from ratecraft.operators import aggregates as A
    df = spark.range(20000).selectExpr("id % 5000 AS u")
    exact = A.distinct_counts(df, ["u"]).first()[0]
    approx = A.distinct_counts(df, ["u"], approx_rsd=0.02).first()[0]
    assert exact == 5000 and abs(approx - exact) < 0.1 * exact


def test_list_fields_are_an_argument():
    mapping = {"properties": {"genres": {"type": "keyword"}, "tags": {"type": "keyword"}, "n": {"type": "integer"}}}
    kinds = {f.name: f.dataType.simpleString() for f in S.mapping_to_schema(mapping, array_fields=["tags", "n"]).fields}
    assert kinds == {"genres": "string", "tags": "array<string>", "n": "array<bigint>"}


def test_short_list_titles_and_minimum_activity(spark):
    from ratecraft.operators import aggregates as A
    from ratecraft.operators import joins as J
    from ratecraft.plans.pages import titles
    items = spark.createDataFrame([(3, "c"), (1, "a"), (None, "x"), (2, "b")], "item_id long, title string")
    assert {r.title for r in J.keep_listed(items, "item_id", [1, 3, 9, None]).collect()} == {"a", "c"}
    assert J.keep_listed(items, "item_id", []).count() == 0
    assert titles(items).count() == 4
    assert [r.title for r in titles(items, limit=2).collect()] == ["a", "b"]
    acts = spark.createDataFrame([(1,), (1,), (2,)], "user_id long")
    assert {tuple(r) for r in A.min_activity(acts, minimum=2).collect()} == {(1, 2, True), (2, 1, False)}
    assert [tuple(r) for r in A.min_activity_violations(acts, minimum=2).collect()] == [(2, 1)]


def test_equal_lengths_are_screened_not_sorted(monkeypatch):
    """Items of one length rule nothing out: every block is scored, but only the first one is searched for its
    best items; later ones are compared with the list so far.  Scores that single precision cannot tell apart count."""
    from ratecraft.operators import factors
    rng = np.random.default_rng(8)
    items = rng.normal(size=(6 * factors.BLOCK, 8))
    items /= np.linalg.norm(items, axis=1, keepdims=True)
    users = rng.normal(size=(40, 8))
    items[3000:3200] = items[11] * (1 + np.arange(200) * 1e-10)[:, None]
    calls, plain = [], np.partition
    monkeypatch.setattr(factors.np, "partition", lambda *a, **k: calls.append(1) or plain(*a, **k))
    scores, ids = np.full((40, 10), -np.inf), np.full((40, 10), np.iinfo(np.int64).max)
    scored, _ = factors._Group(np.arange(len(items)), items, 0.0).scan(users, 10, scores, ids)
    exact = users @ items.T
    assert (scored == len(items)).all() and len(calls) == 1
    for u in range(40):
        assert np.allclose(scores[u], np.sort(exact[u])[::-1][:10], rtol=1e-14)
        assert set(ids[u]) == set(np.argsort(-exact[u])[:10])


def test_fits_of_a_cross_validation_leave_few_shuffle_files(spark):
    import time

    def files():
        store = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (store.apply(i).getName() for i in range(store.size()))
        return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}
    folded = M.prepare(_planted(spark, 40, 30)[1]).withColumn(
        "fold", (F.col("item_id") % 3 + F.col("user_id")) % 3 + 1)
    before = files()
    M.kfold_als(folded, ranks=(2,), iters=(4,), regs=(0.02, 0.1, 1.0))
    for _ in range(20):  # Spark deletes them in the background
        left = {n.split("_")[1] for n in files() - before}
        if len(left) <= 30:
            break
        time.sleep(0.5)
    assert len(left) <= 30  # shuffles; the ten fits make over a hundred


def test_grid_fits_take_blocks_by_rows_and_the_best_model_all(spark, monkeypatch):
    """Small fits run side by side in one block each; the best model, fitted alone, has a block per core."""
    ratings = M.prepare(_planted(spark, 40, 30)[1])
    made, fit = [], M.ALS.fit

    def seen(self, dataset, params=None):
        model = fit(self, dataset, params)
        if params:
            parent = model._java_obj.parent()
            made.append((int(parent.getNumUserBlocks()), int(parent.getNumItemBlocks()), int(parent.getMaxIter())))
        return model
    monkeypatch.setattr(M.ALS, "fit", seen)
    cores = spark.sparkContext.defaultParallelism
    model, table = M.tune_als(ratings, ranks=(1, 2), iters=(1, 2), regs=(0.1,))
    assert table.count() == 4 and len(made) == 5
    assert {m[:2] for m in made[:4]} == {(1, 1)} and made[4][:2] == (cores, cores)
    monkeypatch.setattr(M, "FIT_ROWS", 1)
    made.clear()
    M.tune_als(ratings, ranks=(1,), iters=(1,), regs=(0.1,))
    assert {m[:2] for m in made} == {(cores, cores)}
