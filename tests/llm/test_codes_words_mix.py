"""Vector codes, spelling variants and source mixing against plain rules."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecraft.llm import codes, mixing, queries, spelling
from ratecraft.llm.common import numbered


# vector codes ---------------------------------------------------------------------
def plain_codes(rows, entries=256, rounds=4, parts=4):
    """(id, label, codes, error) and codebooks by measuring every part against every entry."""
    kept = [(i, l, [int(np.floor(1024 * x)) for x in v]) for i, v, l in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    w = len(kept[0][2]) // parts
    cut = [[r[2][p * w:(p + 1) * w] for p in range(parts)] for r in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def near(p, x):
        gaps = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in books[p]]
        return gaps.index(min(gaps)), min(gaps)

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for c in cut:
                held.setdefault(near(p, c[p])[0], []).append(c[p])
            for e, xs in held.items():
                books[p][e] = [sum(col) // len(xs) for col in zip(*xs)]
    out = []
    for (i, l, _), c in zip(kept, cut):
        got = [near(p, c[p]) for p in range(parts)]
        out.append((i, l, tuple(g[0] for g in got), sum(g[1] for g in got)))
    return out, books


def sorted_rows(rows):
    return sorted(rows, key=repr)


def test_codes_equal_the_plain_rule(spark):
    rnd = random.Random(5)
    rows = [(i, [rnd.choice([-0.5, 0.0, 0.25, rnd.gauss(0, 0.3)]) for _ in range(8)], i % 3) for i in range(120)]
    rows += [(7, rows[7][1], 1), (None, rows[3][1], None), (500, None, 2), (501, [None] * 8, 2),
             (502, [float("nan")] * 8, 0), (503, [float("inf")] * 8, 0), (8, [0.125] * 8, None)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "vec_id long, embedding array<double>, label int, id int, codes string")
    got, books = codes.compress(df.repartition(5), entries=20)
    want, plain = plain_codes(rows, entries=20)
    assert sorted_rows((r.id, r.label, tuple(r.codes), r.error) for r in got.collect()) == sorted_rows(want)
    assert [b.tolist() for b in books] == plain


def test_codes_of_few_equal_short_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>, label int"
    none, books = codes.compress(spark.createDataFrame([(1, None, 1)], schema))
    assert none.count() == 0 and books == [] and none.columns == ["id", "label", "codes", "error"]
    same, books = codes.compress(spark.createDataFrame([(1, [0.5] * 8, 1)] * 300, schema))
    assert {(tuple(r.codes), r.error) for r in same.collect()} == {((0, 0, 0, 0), 0)} and same.count() == 300
    short, _ = codes.compress(spark.createDataFrame([(1, [0.5], 1), (2, [], 1), (3, [0.5] + [0.0] * 4, 1)], schema))
    assert {r.id: r.error for r in short.collect()} == {1: 0, 2: 0, 3: 0}
    with pytest.raises(Exception, match="2\\^26"):
        codes.compress(spark.createDataFrame([(1, [1e9] * 4, 1)], schema))[0].collect()


def test_slices_find_the_nearest_entry_and_measure_few():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 1, (90, 12))
    points = np.floor(256 * (centres[rng.integers(0, 90, 500)] + rng.normal(0, 0.1, (500, 12)))).astype(np.int64)
    entries = np.concatenate([points[:150], points[:10]])  # ten entries twice: the lower index wins
    best, error, measured = codes.SliceIndex(entries).nearest(points)
    gaps = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (best == gaps.argmin(axis=1)).all() and (error == gaps.min(axis=1)).all()
    assert measured < 0.2 * gaps.size


# spelling variants ----------------------------------------------------------------
def plain_variants(counts):
    near = {w: [v for v in counts if spelling.one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    rows = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return sorted(rows)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_one_edit_is_edit_distance_one():
    rnd = random.Random(1)
    words = ["".join(rnd.choice("ab") for _ in range(rnd.randint(0, 5))) for _ in range(60)]
    every = [(a, b) for a in words for b in words]
    for a, b in every:
        assert spelling.one_edit(a, b) == (edit_distance(a, b) == 1)
    left, right = spelling.Words([a for a, _ in every], spelling.GROUPS), spelling.Words([b for _, b in every], ())
    at = np.arange(len(every))
    assert spelling._edit_apart(left, at, right, at).tolist() == [spelling.one_edit(a, b) for a, b in every]


@pytest.mark.parametrize("subtree", [3, 40, 30_000])
def test_variants_equal_the_plain_rule(spark, subtree):
    """A small bound cuts the trie at every level and the fullest leaves into chunks."""
    rnd = random.Random(3)
    stems = ["".join(rnd.choice("eainrstoludcmpgxyé") for _ in range(rnd.randint(4, 9))) for _ in range(40)]
    words = set(stems) | {"", "a", "ab", "x" * 400, "x" * 399 + "y", "x" * 401, "漢字漢字", "漢字漢"}
    words |= {"".join(rnd.sample("eeaai", 5)) for _ in range(30)}  # equal counts: one leaf
    for s in stems:
        i = rnd.randrange(len(s))
        words |= {s[:i] + s[i + 1:], s[:i] + "e" + s[i:], s[:i] + rnd.choice("az") + s[i + 1:]}
    counts = {w: rnd.choice([1, 2, 3, 6, 12, 50]) for w in words}
    rows = [(w, n, "x", w) for w, n in counts.items()] + [(None, 5, "x", None)]
    df = spark.createDataFrame(rows, "word string, n long, path string, form string")
    got = spelling.group_variants(df, subtree=subtree).collect()
    assert sorted(tuple(r) for r in got) == plain_variants(counts)


def test_variants_of_no_words_and_chains(spark):
    df = spark.createDataFrame([], "word string, n long")
    assert spelling.group_variants(df).count() == 0
    chain = {"a" * k: 2 ** k for k in range(1, 20)}  # each is a variant of the next: nineteen steps
    got = {r.word: r.root for r in spelling.group_variants(
        spark.createDataFrame(list(chain.items()), "word string, n long")).collect()}
    assert set(got.values()) == {"a" * 19}
    twice = spark.createDataFrame([("word", 2), ("word", 3)], "word string, n long")
    assert [tuple(r) for r in spelling.group_variants(twice).collect()] == [("word", None, "word", 5, 0, None)]


def test_words_are_runs_with_some_letters_lost(spark, nasty):
    import re

    counts = {}
    for r in nasty.collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = run.translate(str.maketrans(spelling.UPPER, spelling.LOWER))
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] = counts.get(run, 0) + 1
    want = {w: n for w, n in counts.items() if len(w) >= 4 and n >= 2}
    assert {r.word: r.n for r in queries.spelled_words(nasty, least=4, times=2).collect()} == want


# source mixing --------------------------------------------------------------------
def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets per source by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, held = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in held]
        part = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        over = [s for s in free if part[s] > most * sizes[s]]
        if not over:
            return held | part
        for s in over:
            held[s] = most * sizes[s]
            left -= held[s]


def documents(spark, n=3000):
    rnd = random.Random(9)
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else rnd.choice(["a", "b", "Z", "é", None, "mini"] if i < 50 else ["a", "b", "Z", "é", None])
        rows.append((i if i % 4 else None, source, rnd.choice([0, 1, 20, 50, 50, 300, rnd.randint(1, 2000)])))
    rows += [(7, "a", 11)] * 40 + [(None, None, None), (9, "void", 0), (10, "void", -3)]
    return rows, spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, source string, w int, size int, mark string")


def test_mix_meets_the_targets(spark):
    rows, df = documents(spark)
    sizes = {}
    for _, s, w in rows:
        sizes[s] = sizes.get(s, 0) + max(w or 0, 0)
    want = plain_targets(sizes)
    kw = dict(carry=["doc_id"], block_rows=200)
    got = mixing.mix(df, F.col("w"), F.col("source"), **kw).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id or -1, r.source or "", r["size"]) for r in got) == sorted(
        (i or -1, s or "", max(w or 0, 0)) for i, s, w in rows)
    taken, copies, n = {}, {}, {}
    for r in got:
        assert r.taken == r["size"] * r.copies and 0 <= r.copies <= 2 and r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6
        for k, v in ((taken, r.taken), (copies, r.copies), (n, 1)):
            k[r.source] = k.get(r.source, 0) + v
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(0.01 * t, 60)
        if sizes[s]:
            assert abs(copies[s] - n[s] * t / sizes[s]) <= 4
    again = mixing.mix(df.repartition(7), F.col("w"), F.col("source"), **kw).collect()
    assert sorted_rows(map(tuple, again)) == sorted_rows(map(tuple, got))


def test_mix_spreads_equal_rows(spark):
    same = spark.range(30_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.lit(10).alias("w"))
    more = same.union(spark.createDataFrame([(1, "t", 500_000)], "doc_id long, source string, w int"))
    got = mixing.mix(more, F.col("w"), F.col("source"), ["doc_id"], block_rows=1000)
    total = {r.source: (r.n, r.taken, r.target) for r in got.groupBy("source").agg(
        F.count("*").alias("n"), F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()}
    assert total["s"][0] == 30_000 and abs(total["s"][1] - total["s"][2]) <= 10
    copies = numbered(same).select("copy").collect()
    assert sorted(r["copy"] for r in copies) == list(range(30_000))


def test_mix_of_nothing_and_of_empty_texts(spark, nasty, empty):
    words = F.regexp_count(F.col("text"), F.lit(r"\S+"))
    assert mixing.mix(empty, words, F.col("fp"), ["doc_id"]).count() == 0
    got = mixing.mix(nasty.where("text IS NULL OR text = ''"), words, F.col("fp"), ["doc_id", "text"]).collect()
    assert {(r.target, r.taken) for r in got} == {(0.0, 0)}
    assert sorted(r.text or "-" for r in mixing.mix(nasty, words, F.col("fp"), ["text"]).collect()) == sorted(
        r.text or "-" for r in nasty.collect())


def test_flight_keeps_totals_and_expectations():
    sizes, probs = [random.Random(i).randint(1, 900) for i in range(400)], [0.3] * 400
    mean = np.zeros(400)
    for seed in range(300):
        got = mixing.flight(sizes, probs, random.Random(seed))
        assert abs(np.dot(got, sizes) - np.dot(probs, sizes)) < 1e-3 and abs(sum(got) - sum(probs)) < 1e-6
        assert sum(0 < p < 1 for p in got) <= 2
        mean += got
    assert abs((mean / 300).mean() - 0.3) < 0.01 and np.abs(mean / 300 - 0.3).max() < 0.15
