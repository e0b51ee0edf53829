"""SimHash and embedding near-duplicates and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from ratecraft.llm import simhash
from ratecraft.llm.components import connected_components
from ratecraft.llm.embedding_dedup import near_duplicates as embedding_groups
from ratecraft.llm.hnsw import Graph


def groups_of(nodes, linked):
    """node -> smallest reachable node, by depth-first search."""
    out = {}
    for start in sorted(nodes):
        stack = [start]
        while stack:
            x = stack.pop()
            if x not in out:
                out[x] = start
                stack += [y for y in nodes if y not in out and linked(x, y)]
    return out


def plain_fingerprint(text, width):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else " " if c in " \t\n\v\f\r" else c
                                for c in text or "").split(" ") if w]
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + width]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def test_fingerprints_equal_the_plain_rule(spark, nasty):
    got = {r.id: r.fp for r in simhash.fingerprints(nasty).collect()}
    for r in nasty.collect():
        want = plain_fingerprint(r.text, 3)
        assert got[r.doc_id] % (1 << 64) == want
    assert got[3] == got[4] == got[5] == 0


def test_groups_equal_brute_force(spark):
    rnd = random.Random(5)
    fps = [rnd.getrandbits(64) for _ in range(150)]
    for _ in range(250):  # chains of close neighbours
        fps.append(rnd.choice(fps) ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4))))
    fps += [0, 1 << 63, (1 << 64) - 1]
    signed = sorted({f - (1 << 64) if f >> 63 else f for f in fps})
    want = groups_of(signed, lambda a, b: bin((a ^ b) % (1 << 64)).count("1") <= 3)
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for bucket_rows in (1000, 3, 1):  # small limits push rows to the finer levels
        roots = {r.node: r.root for r in connected_components(simhash.links(df, 3, bucket_rows)).collect()}
        assert {f: roots.get(f, f) for f in signed} == want


@pytest.mark.parametrize("blocks", [5, 8, 16])
def test_every_close_pair_shares_a_block_choice(blocks):
    rnd = random.Random(blocks)
    masks = simhash.block_masks(3, blocks)
    for _ in range(300):
        a = rnd.getrandbits(64)
        b = a ^ sum(1 << i for i in rnd.sample(range(64), 3))
        assert any((a & m % (1 << 64)) == (b & m % (1 << 64)) for m in masks)


def test_awkward_documents(spark, nasty, empty):
    rows = simhash.near_duplicates(nasty).collect()
    assert len(rows) == nasty.count()
    assert {r.component for r in rows if r.id in (1, 2)} == {1}
    assert {r.component for r in rows if r.id in (3, 4, 5)} == {3}
    assert [r.component for r in rows if r.id is None] == [None]
    kept = simhash.keep_one(nasty)
    assert kept.columns == nasty.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [1, 3, 6, 7, 8, 9, 10, 11, 12] and kept.where("doc_id is null").count() == 1
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_one_row_of_every_group_stays(spark):
    one, two, three = (" ".join(f"{w}{i}" for i in range(40)) for w in ("alpha", "beta", "gamma"))
    rows = [(None, one), (None, one), (None, two), (None, three), (4, three), (7, "first text of an id"),
            (7, "another one of the same id"), (None, "lonely"), (4, "")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, fp int")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    key = lambda x: (x[1], x[0] or 0)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=key) == sorted(
        [(None, one), (None, two), (4, three), *rows[5:]], key=key)


def test_components_of_a_long_chain_a_star_and_no_links(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5), (7, 8), (8, 7)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def _vectors(n=700, d=24, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    for lo, hi in ((0, 150), (200, 230)):  # tight clusters, one larger than a beam
        x[lo:hi] = x[lo] + 0.05 * rng.normal(size=(hi - lo, d))
    x[300:340] = x[300]  # copies
    return x.astype(np.float32)


def test_embedding_groups_equal_brute_force(spark):
    x = _vectors()
    odd = [(9001, None), (9002, [0.0] * 24), (9003, [float("nan")] * 24), (9004, [None] * 24), (9005, [1.0, 2.0]),
           (9006, [2.0, 4.0]), (9007, []), (9008, [float("inf")] * 24), (None, x[0].tolist())]
    rows = [(i + 1, v.tolist(), 1) for i, v in enumerate(x)] + [(i, v, 1) for i, v in odd]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, weight int")
    got = {r.id: r for r in embedding_groups(df, shards=3).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    comp = groups_of(range(len(x)), lambda a, b: near[a, b])
    links = near.sum(axis=1) - 1
    found = sum(got[i + 1].n_links for i in range(len(x)))
    assert found >= 0.98 * links.sum() and all(got[i + 1].n_links <= links[i] for i in range(len(x)))
    assert all(got[i + 1].component == comp[i] + 1 for i in range(len(x)))
    for i in (9001, 9002, 9003, 9004, 9007, 9008):
        assert (got[i].n_links, got[i].component, got[i].kept) == (0, i, True)
    assert (got[9005].n_links, got[9006].component) == (1, 9005) and got[None].n_links == 0
    assert embedding_groups(df.limit(0)).count() == 0


def test_graph_recall(spark):
    x = np.random.default_rng(1).normal(size=(3000, 16)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got, _ = Graph(x).search(x[:200], 48)
    true = np.argsort(-(x[:200] @ x.T), axis=1)[:, :10]
    assert np.mean([len(set(t) & set(g[:10])) / 10 for t, g in zip(true, got)]) >= 0.9


def test_one_id_with_two_vectors_is_two_rows(spark):
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.99, 0.01, 0.0]
    rows = [(5, a), (5, b), (9, c), (9, c), (2, b), (None, a), (7, None), (7, a)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.id if r.id is not None else -1, r.n_links, r.component) for r in embedding_groups(df).collect())
    # equal vectors under several ids are linked too; a repeated row is one vector
    assert got == [(-1, 0, None), (2, 1, 2), (5, 1, 2), (5, 2, 5), (7, 0, 7), (7, 2, 5), (9, 2, 5), (9, 2, 5)]


def test_a_graph_that_misses_nodes_is_answered_exactly():
    from ratecraft.llm.embedding_dedup import _Shard

    rng = np.random.default_rng(3)
    vecs = np.repeat(rng.normal(size=(20, 8)), 10, axis=0) + 1e-3 * rng.normal(size=(200, 8))
    shard = _Shard(0.95, 0.98, 4, np.arange(200), vecs, np.ones(200, dtype=np.int64))
    shard.graph.search = lambda x, beam: (np.full((len(x), 1), -1), np.zeros((len(x), 1)))
    (out,) = shard.answer(np.arange(200), vecs)
    assert out.column(2).to_pylist() == [9] * 200
