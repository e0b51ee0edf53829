"""Running statistics, row index, leave-n-out and folds against plain
single-task computations, including one hot key holding a third of the rows."""

import random

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from ratecraft.operators import windows as W


def _events(spark, n=3000, keys=20, seed=7):
    rnd = random.Random(seed)
    rows = []
    for seq in rnd.sample(range(n * 5), n):
        key = 0 if rnd.random() < 0.34 else rnd.randrange(1, keys)  # key 0 is hot
        val = None if rnd.random() < 0.05 else float(rnd.randint(1, 5))
        rows.append((seq, key, val))
    return spark.createDataFrame(rows, "seq long, item_id long, rating double")


def test_running_stats_matches_plain_window_with_hot_key(spark):
    df = _events(spark)
    got = W.running_stats(df, ["item_id"], ["seq"], "rating", rows_per_chunk=50)
    w = Window.partitionBy("item_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.select("seq", F.count(F.lit(1)).over(w).alias("c"), F.sum("rating").over(w).alias("s"),
                    F.avg("rating").over(w).alias("m"))
    a = {r.seq: (r.run_count, r.run_sum, r.run_mean) for r in got.collect()}
    b = {r.seq: (r.c, r.s, r.m) for r in exp.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][0] == b[k][0]
        for x, y in zip(a[k][1:], b[k][1:]):
            assert (x is None and y is None) or abs(x - y) < 1e-9


def _orders(n):
    """Order values that defeat equal-width chunks: hot first column, one outlier, strings, nulls, NaN."""
    return {"hot": ("k int", [0 if i % 2 else i for i in range(n)]),
            "outlier": ("k long", [10 ** 15 if i == 5 else i % 700 for i in range(n)]),
            "string": ("k string", [f"w{i % 900:04d}" if i % 7 else None for i in range(n)]),
            "double": ("k double", [None if i % 9 == 0 else float("nan") if i % 9 == 1 else i / 3 for i in range(n)])}


def test_every_row_gets_one_position_and_no_chunk_is_large(spark):
    n = 4000
    for name, (kind, values) in _orders(n).items():
        df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"{kind}, i int")
        laid = W.in_order(df, ["k", "i"], parts=20)
        assert max(r["count"] for r in laid.groupBy("_part").count().collect()) <= n / 8, name
        got = [r.i for r in W.row_index(df, ["k", "i"]).orderBy("row_idx").collect()]
        assert got == [r.i for r in df.orderBy("k", "i").collect()], name
        folds = W.contiguous_kfold(df, ["k", "i"], 4).groupBy("fold").count().collect()
        assert {r.fold: r["count"] for r in folds} == {f: n // 4 for f in range(1, 5)}


def test_running_stats_keeps_null_keys_and_null_orders(spark):
    df = spark.createDataFrame([(None if i % 4 == 0 else i % 3, None if i % 5 == 0 else i, i) for i in range(400)],
                               "k int, o int, i int")
    w = Window.partitionBy("k").orderBy("o", "i")
    exp = {r.i: r.c for r in df.select("i", F.row_number().over(w).alias("c")).collect()}
    got = W.running_stats(df, ["k"], ["o", "i"]).collect()
    assert len(got) == 400 and {r.i: r.run_count for r in got} == exp
    got = W.running_stats(df, ["k"], ["o", "i"], "i", rows_per_chunk=20).collect()
    assert len(got) == 400 and {r.i: r.run_count for r in got} == exp


def test_row_index_is_a_permutation_in_order(spark):
    df = _events(spark, n=1500)
    got = W.row_index(df, ["seq"]).orderBy("seq").select("row_idx").collect()
    assert [r.row_idx for r in got] == list(range(1500))


def _expected_test_rows(rows, start, stop, cap):
    """From the stated rule: number each user's rows, keep numbers in range, cut at the cap."""
    table = pd.DataFrame(rows, columns=["seq", "user"]).sort_values("seq")
    candidate = (table.groupby("user").cumcount() + 1).between(start, stop)
    chosen = candidate & (candidate.cumsum() <= (cap if cap > 0 else len(table)))
    return list(zip(table["seq"].tolist(), chosen.tolist()))


def test_leave_n_out_matches_rule_with_and_without_cap(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.randrange(30)) for i in range(2000)]
    df = spark.createDataFrame(rows, "seq long, user_id long")
    for start, stop, cap in [(1, 10, 0), (11, 20, 100), (1, 10, 100000)]:
        got = W.leave_n_out(df, "user_id", ["seq"], start, stop, cap)
        assert sorted((r.seq, r.is_test) for r in got.collect()) == _expected_test_rows(rows, start, stop, cap)


def test_contiguous_kfold_blocks(spark):
    df = spark.range(100).withColumnRenamed("id", "seq")
    got = {r.seq: r.fold for r in W.contiguous_kfold(df, ["seq"], 5).collect()}
    assert all(got[i] == i // 20 + 1 for i in range(100))


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, 1, 3.0), (1, 5, 4.0), (2, 2, 1.0), (1, 3, 2.0)],
                               "k long, seq long, v double")
    got = {r.k: r.v for r in W.latest_per_key(df, ["k"], ["seq"], ["v"]).collect()}
    assert got == {1: 4.0, 2: 1.0}


def test_pages_follow_the_order_at_every_depth(spark):
    from ratecraft.operators.topk import paginate
    df = spark.createDataFrame([(None if i % 10 == 0 else i, i) for i in range(100)], "o int, i int")
    want = [r.i for r in df.orderBy("o", "i").collect()]
    for page in (1, 2, 7, 10):
        got = paginate(df, ["o", "i"], page, 10).orderBy("o", "i").collect()
        assert [r.i for r in got] == want[10 * page - 10:10 * page]
    assert paginate(df, ["o", "i"], 11, 10).count() == 0 and paginate(df, ["o", "i"], 0, 10).count() == 0


def scanned_rows(df) -> int:
    """Rows that the file scans of a DataFrame put out, from its run's own metrics."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if hasattr(plan, "finalPhysicalPlan") and "Adaptive" in plan.nodeName() else plan
    leaves, total = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numOutputRows")
        total += metric.get().value() if metric.isDefined() else 0
    return total


def test_a_page_reads_its_file_only(spark, tmp):
    from ratecraft.operators.paging import PageIndex
    n = 100_000
    df = spark.range(n).select(F.when(F.col("id") % 10 > 0, F.col("id") * 7919 % n).alias("o"), F.col("id").alias("i"))
    PageIndex.build(df, ["o", "i"], f"{tmp}/index", parts=200)
    index = PageIndex(spark, f"{tmp}/index")  # as another session would open it
    want = [r.i for r in df.orderBy(F.asc_nulls_first("o"), "i").collect()]
    assert index.total() == n and index.fences.count() >= 150
    for page in (1, 2, 3000, 10_000):
        got = index.page(page, 10)
        assert [(r.position, r.i) for r in got.orderBy("position").collect()] == list(
            enumerate(want[10 * page - 10:10 * page], 10 * page - 10))
        assert scanned_rows(index.page(page, 10)) < n / 100
    across = index.slice(400, 1600).collect()  # several files
    assert sorted((r.position, r.i) for r in across) == list(enumerate(want[400:1600], 400))
    assert index.page(10_001).count() == 0 and index.page(0).count() == 0
    some = df.where("o = 5001").first()
    assert want[index.place_of(5001)] == some.i and index.place_of(n) == n


def test_page_index_of_an_empty_table(spark, tmp):
    from ratecraft.operators.paging import PageIndex
    index = PageIndex.build(spark.createDataFrame([], "o int, i int"), ["o"], f"{tmp}/none")
    assert index.total() == 0 and index.page(1).count() == 0
