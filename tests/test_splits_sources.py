"""Splits (M1) and flat-file sources (S1-S5), on synthetic files."""


from ratecraft.operators.splits import hash_kfold, hash_split, random_split
from ratecraft.sources import files as FS


def test_hash_split_disjoint_complete_and_stable(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    tr, te = hash_split(df, ["k"], 0.8, seed=42)
    a = {r.k for r in tr.collect()}
    b = {r.k for r in te.collect()}
    assert not (a & b) and len(a | b) == 5000 and 3700 < len(a) < 4300
    tr2, _ = hash_split(df.repartition(13), ["k"], 0.8, seed=42)
    assert {r.k for r in tr2.collect()} == a


def test_random_split_disjoint_complete(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    parts = random_split(df, (0.8, 0.2), seed=42, order=["k"])
    keys = [set(r.k for r in p.collect()) for p in parts]
    assert not (keys[0] & keys[1]) and len(keys[0] | keys[1]) == 2000


def test_hash_kfold_range(spark):
    folds = {r.fold for r in hash_kfold(spark.range(500), ["id"], 5).collect()}
    assert folds == {1, 2, 3, 4, 5}


def test_read_ratings_items_users_lookup_totals(spark, tmp):
    with open(f"{tmp}/r.tsv", "w") as f:
        f.write("1\t10\t4\t1000000000\n2\t20\t3\t1000000001\n")
    r = FS.read_ratings(spark, [f"{tmp}/r.tsv", f"{tmp}/r.tsv"])
    assert r.count() == 4 and dict(r.dtypes)["rating"] == "float"
    with open(f"{tmp}/items", "w", encoding="latin-1") as f:
        f.write("1|Café (1995)|01-Jan-1995||http://x|0|1|1\n2|Plain|||u|0|0|0\n")
    it = FS.read_items(spark, f"{tmp}/items", ["unknown", "Action", "Children's"]).orderBy("item_id").collect()
    assert it[0].title == "Café (1995)" and it[0].genres == ["Action", "Children's"] and it[1].genres == []
    with open(f"{tmp}/users", "w") as f:
        f.write("1|61|F|baker|00017\n2|19|M|pilot|X9Y\n3|44|F|clerk|70000\n")
    us = {r.user_id: r.zipcode for r in FS.read_users(spark, f"{tmp}/users").collect()}
    assert us == {1: "00017", 2: "X9Y", 3: "70000"}  # zip stays a string
    with open(f"{tmp}/genre", "w") as f:
        f.write("unknown|0\nAction|1\n\n")
    assert FS.read_lookup(spark, f"{tmp}/genre").count() == 2
    with open(f"{tmp}/info", "w") as f:
        f.write("7 users\n11 items\n23 ratings\n")
    t = {r.what: r.n for r in FS.read_totals(spark, f"{tmp}/info").collect()}
    assert t == {"users": 7, "items": 11, "ratings": 23}


def test_json_round_trip(spark, tmp):
    from ratecraft.functions.columns import nest_record
    df = spark.createDataFrame([(1, 2, "x", ["A"], 4.0, 1000000000)],
                               "u long, m long, t string, g array<string>, r double, ts long")
    rec = nest_record({"userId": "u"}, {"movieId": "m", "title": "t", "genres": "g"}, "r", "ts")
    js = FS.to_json_lines(df.select(rec.alias("record"))).first().json
    assert js == '{"user":{"userId":"1"},"movie":{"movieId":"2","title":"x","genres":["A"]},"rating":"4.0","timestamp":"1000000000"}'
    FS.write_json(df.select(rec.alias("record")).select("record.*"), f"{tmp}/j")
    assert spark.read.json(f"{tmp}/j").count() == 1


def test_buckets_grow_with_the_rows():
    from ratecraft.sources.bucketed import ROWS_PER_BUCKET, buckets_for
    assert buckets_for(0) == buckets_for(8 * ROWS_PER_BUCKET) == 8
    assert buckets_for(216_000_000) * ROWS_PER_BUCKET >= 216_000_000
