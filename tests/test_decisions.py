"""More decisions of SURVEY §2.14: Q1 explicit limits, Q10 empty result for
an unknown title, Q13 per_page validation, Q16 separators as arguments."""

import pytest
from pyspark.sql import functions as F

from ratecraft.operators import aggregates as A
from ratecraft.operators import topk as TK
from ratecraft.plans import recommend as M


def test_per_page_must_be_positive(spark):
    df = spark.range(5)
    with pytest.raises(ValueError):
        A.page_totals(df, 0)
    with pytest.raises(ValueError):
        TK.paginate(df, ["id"], 1, 0)
    r = A.page_totals(df, 2).first()
    assert (r.total_items, r.total_pages) == (5, 3)


def test_no_hidden_cut_at_ten(spark):
    df = spark.createDataFrame([(1, i, float(i)) for i in range(25)], "g long, i long, v double")
    got = TK.top_k_per_group(df, ["g"], [F.desc("v"), F.asc("i")], 25)
    assert got.count() == 25  # the caller's k, not a server default


def test_unknown_title_gives_empty_result(spark):
    items = spark.createDataFrame([(1, "Red Widget"), (2, "Blue Bolt"), (3, "Red Bolt")],
                                  "item_id long, title string")
    reviews = spark.createDataFrame([(10, 1), (11, 1), (10, 3), (12, 2)], "user_id long, item_id long")
    ratings = spark.createDataFrame([(10, 1, 4.0), (11, 1, 3.0), (10, 3, 5.0), (12, 2, 2.0), (11, 2, 1.0)],
                                    "user_id long, item_id long, rating double")
    model = M.fit_als(M.prepare(ratings), rank=2, max_iter=3)
    titles = spark.createDataFrame([(1, "red widget"), (2, "nothing like it")], "qid long, title string")
    stages = M.title_reviewers(titles, items, reviews, 10)
    assert {r.qid for r in stages.collect()} == {1}
    out = M.recommend_for_titles(titles, items, reviews, model)
    assert {r.qid for r in out.collect()} <= {1}  # no row, not an error, for the unknown title


def test_separator_is_an_argument(spark, tmp):
    from ratecraft.sources import files as FS
    with open(f"{tmp}/users.tsv", "w") as f:
        f.write("1\t61\tF\tbaker\t00017\n")
    assert FS.read_users(spark, f"{tmp}/users.tsv", sep="\t").first().zipcode == "00017"


def test_page_response_edges(spark):
    from ratecraft.plans.pages import page_index, page_response
    df = spark.range(25).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    index = page_index(df, ["k"], F.struct(F.col("v").alias("v")))
    p3 = page_response(index, page=3, per_page=10).orderBy("position").collect()
    assert [r.position for r in p3] == [1, 2, 3, 4, 5] and all(r.total_pages == 3 for r in p3)
    assert p3[0].json == '{"v":40}'
    assert page_response(index, page=4, per_page=10).count() == 0   # past the last page
    assert page_response(index, page=0, per_page=10).count() == 0
    deep = page_response(index, page=2, per_page=10)
    assert [r.json for r in deep.orderBy("position").collect()][0] == '{"v":20}'


def test_page_records_are_made_after_the_shuffle(spark, monkeypatch):
    from ratecraft.operators import paging
    from ratecraft.plans.pages import page_index, page_response
    shuffled, placed = [], paging.in_order
    monkeypatch.setattr(paging, "in_order", lambda df, *a: shuffled.append(df.columns) or placed(df, *a))
    df = spark.range(25).select(F.col("id").alias("k"), F.concat(F.lit("t"), "id").alias("v"))
    index = page_index(df, ["k"], F.struct(F.col("k"), F.col("v").alias("v")))
    assert shuffled == [["k", "v"]] and index.rows.columns == ["k", "_record", "_at", "_part"]
    rows = page_response(index, page=3, per_page=10).orderBy("position").collect()
    assert [r.json for r in rows] == [f'{{"k":{i},"v":"t{i}"}}' for i in range(20, 25)]


def test_users_joined_to_the_orders_give_the_same_ratings(spark, tmp):
    """Repeated, missing and null users, orders and line items."""
    import datetime as dt

    from ratecraft.sources.tables import ratings_view
    spark.createDataFrame([(1, 7), (2, 8), (2, 8), (3, None), (None, 7), (4, 9)],
                          "o_orderkey long, o_custkey long").write.parquet(f"{tmp}/orders.parquet")
    day = dt.date(2020, 1, 2)
    lines = [(o, n, p, 5, float(n), 1.0, 0.0, 0.0, "A", "F", day)
             for o in (1, 2, 3, 4, 5, None) for n, p in ((1, 10), (2, 11), (2, 11), (3, None))]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                          "l_linestatus string, l_shipdate date").write.parquet(f"{tmp}/lineitem.parquet")
    users = spark.createDataFrame([(7, 30, "F"), (8, 31, None), (8, 32, "M"), (None, 1, "F")],
                                  "user_id long, age int, gender string")
    for ordered in (False, True):
        after = ratings_view(spark, tmp, ordered).join(users, "user_id")
        got = ratings_view(spark, tmp, ordered, users)
        assert set(got.columns) == set(after.columns)
        assert sorted(map(str, got.select(after.columns).collect())) == sorted(map(str, after.collect()))
        assert got.count() == 4 + 4 * 4


def test_json_lines_compressed_are_the_same_records(spark, tmp):
    import os

    from ratecraft.sources import files as FS
    df = spark.range(50).select(F.struct(F.col("id"), F.lit("ä\n").alias("t")).alias("record"))
    FS.write_json(df, f"{tmp}/plain")
    FS.write_json(df, f"{tmp}/packed", "gzip")
    assert all(n.endswith(".json.gz") for n in os.listdir(f"{tmp}/packed") if n.startswith("part-"))
    assert all(n.endswith(".json") for n in os.listdir(f"{tmp}/plain") if n.startswith("part-"))
    assert (sorted(map(str, spark.read.schema(df.schema).json(f"{tmp}/packed").collect()))
            == sorted(map(str, df.collect())))
