"""BPE, token files and token counts against the tokenizers library; packing, search and chat against plain rules."""

import random
import zlib

import numpy as np
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from ratecraft.llm import bpe, chat, packing, threshold_topk, token_counts, token_files
from ratecraft.llm.queries import BYTE_BPE, PIECES

MARK = "▁"


def test_bpe_equals_the_library_and_round_trips(spark, nasty, empty):
    tok = Tokenizer.from_file(BYTE_BPE)
    both = bpe.decode(bpe.encode(nasty, BYTE_BPE), BYTE_BPE).collect()
    want = {r.doc_id: tok.encode(r.text or "", add_special_tokens=False).ids for r in nasty.collect()}
    assert len(both) == nasty.count()
    for r in both:
        assert r.ids == want[r.id] and r.decoded == tok.decode(want[r.id], skip_special_tokens=False)
    assert bpe.encode(nasty, BYTE_BPE, decoded="decoded").collect() == both
    assert bpe.encode(empty, BYTE_BPE).count() == 0
    broken = spark.createDataFrame([([170, 243],), (None,), ([],)], "ids array<int>")
    got = [r.decoded for r in bpe.decode(broken, BYTE_BPE).collect()]
    assert got == [tok.decode([170, 243]), None, ""]


def test_bpe_on_odd_characters_and_small_memo(spark):
    tok = Tokenizer.from_file(BYTE_BPE)
    rnd = random.Random(2)
    chars = "ab 's'\n\t12.!?éß²́ 　漢" + chr(0x1F600)
    texts = ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    enc = bpe.Encoder(bpe.vocabulary(BYTE_BPE).solve, {"<|endoftext|>": 50256}, limit=50)
    for lo in range(0, 3000, 500):
        flat, counts = enc.encode(texts[lo:lo + 500])
        ends = np.cumsum(counts)
        got = [flat[a:b].tolist() for a, b in zip(ends - counts, ends)]
        assert got == [e.ids for e in tok.encode_batch(texts[lo:lo + 500], add_special_tokens=False)]


def test_token_files_hold_the_ids_in_order(spark, nasty, empty, tmp):
    tok = Tokenizer.from_file(BYTE_BPE)
    token_files.write_token_files(nasty, f"{tmp}/t", BYTE_BPE, end_id=2, files=3)
    rows = sorted(nasty.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    got = token_files.positions(spark, f"{tmp}/t").orderBy("start").collect()
    at = 0
    for r, g in zip(rows, got, strict=True):
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [2]
        crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        assert (g.doc_id, g.start, g.n_tokens, g.ids_crc32) == (r.doc_id, at, len(ids), crc)
        at += len(ids)
    hit = token_files.lookup(spark, f"{tmp}/t", [7, 999])
    assert [r.doc_id for r in hit.collect()] == [7] and "In(doc_id" in hit._jdf.queryExecution().toString()
    token_files.write_token_files(empty, f"{tmp}/e", BYTE_BPE, end_id=2)
    assert token_files.positions(spark, f"{tmp}/e").count() == 0


def test_token_files_with_repeated_and_hot_ids(spark, tmp):
    """A third of the rows without an id, ids with several texts, and repeated rows: starts are those of the files."""
    import glob

    import pyarrow.orc as orc

    rows = [(None, f"text {i % 400}") for i in range(700)] + [(None, "same text")] * 700
    rows += [(i % 500, f"other {i}") for i in range(1500)] + [(7, "twice"), (7, "twice"), (8, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    token_files.write_token_files(df, f"{tmp}/t", BYTE_BPE, end_id=2, files=8)
    tables = [orc.read_table(f) for f in glob.glob(f"{tmp}/t/*.orc")]
    tables = sorted((t for t in tables if t.num_rows), key=lambda t: t["part"][0].as_py())
    assert max(t.num_rows for t in tables) < len(rows) / 3
    want, at, last = [], 0, -1
    for t in tables:
        for doc, ids in zip(t["doc_id"].to_pylist(), t["ids"].to_pylist()):
            assert (doc if doc is not None else -1) >= last
            last = doc if doc is not None else -1
            want.append((doc, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
            at += len(ids)
    got = [tuple(r) for r in token_files.positions(spark, f"{tmp}/t").orderBy("start").collect()]
    assert got == want and len(got) == len(rows)


def test_packing_spreads_equal_rows(spark):
    rows = [(None, None, None, 3)] * 6000 + [(1, "a", "c", 5)] * 1000
    df = spark.createDataFrame(rows, "doc_id long, source string, cluster string, n int")
    got = packing.pack(df, F.col("n"), 10, F.col("source"), F.col("cluster"), shard_rows=500).collect()
    sizes, bins = {}, {}
    for r in got:
        sizes[r.shard] = sizes.get(r.shard, 0) + 1
        bins.setdefault((r.shard, r.bin), []).append(r)
    assert len(got) == 7000 and max(sizes.values()) < 800
    for held in bins.values():
        assert sum(r["size"] for r in held) <= 10 and sum(r.id == 1 for r in held) <= 1


def test_token_counts_equal_the_library(spark, nasty, empty):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    vocab = [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]
    tok = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=True))
    got = {r.id: r.n_tokens for r in token_counts.token_counts(nasty, PIECES).collect()}
    for r in nasty.collect():
        want = len(tok.encode(MARK + r.text.replace(" ", MARK)).ids) if r.text else 0
        assert got[r.doc_id] == want
    assert token_counts.token_counts(empty, PIECES).count() == 0


def test_token_count_ties_go_as_in_the_library():
    rnd = random.Random(4)
    for _ in range(60):  # small vocabularies with equal scores: most paths tie
        scores = {"a": -2.0, "b": -2.0, MARK: -1.0}
        for _ in range(8):
            scores["".join(rnd.choice("ab") for _ in range(rnd.randint(2, 4)))] = -float(rnd.randint(1, 4))
        tok = Tokenizer(models.Unigram([("<unk>", -9.0), *scores.items()], unk_id=0))
        own = token_counts.Pieces(scores, byte_fallback=False, worst=-9.0)
        words = [MARK + "".join(rnd.choice("ab") for _ in range(rnd.randint(1, 12))) for _ in range(20)]
        assert own.solve(words)[0].tolist() == [len(tok.encode(w).ids) for w in words]


def plain_best_fit(sizes, classes, capacity):
    bins = []  # [room, classes]
    where = {}
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [b for b, (room, held) in enumerate(bins) if room >= sizes[i] and not held & set(classes[i])]
        b = min(fits, key=lambda b: (bins[b][0], b), default=None)
        if b is None:
            bins.append([capacity, set()])
            b = len(bins) - 1
        where[i] = (b, capacity - bins[b][0])
        bins[b][0] -= sizes[i]
        bins[b][1] |= set(classes[i])
    return [where[i] for i in range(len(sizes))]


def test_best_fit_equals_the_plain_rule():
    rnd = random.Random(8)
    for hot in (0.0, 0.4, 0.9):
        sizes = [rnd.randint(1, 100) for _ in range(600)]
        classes = [(("s", 0 if rnd.random() < hot else rnd.randint(1, 30)), ("c", rnd.randint(0, 200))) for _ in sizes]
        classes[5] = ()
        assert list(zip(*packing.best_fit(sizes, classes, 100))) == plain_best_fit(sizes, classes, 100)


def test_packing_keeps_every_word_and_every_rule(spark, nasty, empty):
    rows = [(i, i % 37 * 9 if i % 11 else 2500, f"s{0 if i % 3 == 0 else i % 9}", f"c{i % 50}") for i in range(900)]
    rows += [(901, None, None, None), (None, 5, "s1", None), (902, 0, "s1", "c1")]
    df = spark.createDataFrame(rows, "doc_id long, n int, src string, cl string")
    for shard_rows in (10_000, 200):
        got = packing.pack(df, F.col("n"), 400, F.col("src"), F.col("cl"), shard_rows=shard_rows).collect()
        assert {r.id for r in got} == {r[0] for r in rows}
        size, bins = {}, {}
        for r in got:
            size[r.id] = size.get(r.id, 0) + r.size
            if r.bin >= 0:
                bins.setdefault((r.shard, r.bin), []).append(r)
        assert size == {i: n or 0 for i, n, *_ in rows}
        of = {r[0]: r for r in rows}
        for held in bins.values():
            held.sort(key=lambda r: r.bin_offset)
            assert sum(r.size for r in held) <= 400
            assert all(a.bin_offset + a.size == b.bin_offset for a, b in zip(held, held[1:]))
            for k in (2, 3):
                marks = [of[r.id][k] for r in held if of[r.id][k] is not None]
                assert len(marks) == len(set(marks))
    assert packing.pack(nasty, F.length("text"), 300, F.col("id"), F.col("text")).count() >= nasty.count()
    assert packing.pack(empty, F.length("text"), 300, F.col("id"), F.col("text")).count() == 0


def test_top_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=(400, 8)), 2)
    x[100:140] = x[100]  # ties
    x[50] = 0  # a query whose scores all tie
    rows = [(int(i), v.tolist(), 1) for i, v in enumerate(x)] + [(0, x[0].tolist(), 1), (None, x[0].tolist(), 1),
            (1000, None, 1), (1050, [float("nan")] * 8, 1), (1100, [1.0], 1), (1101, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    q = np.floor(256 * x).astype(int)
    for shards in (1, 5):
        got = {(r.query_id, r.rank): (r.id, r.score)
               for r in threshold_topk.top_neighbours(df, every=10, shards=shards).collect()}
        want = {}
        for i in range(0, 400, 10):
            best = sorted((-int(q[i] @ q[j]), j) for j in range(400) if j != i)[:5]
            want |= {(i, k + 1): (j, -s) for k, (s, j) in enumerate(best)}
        assert got == want
    assert threshold_topk.top_neighbours(df.limit(0)).count() == 0


def test_scores_past_exact_doubles_stay_exact():
    big = 3.0e8
    lists = threshold_topk._Lists(2, np.arange(4), np.array([[big, 1], [big, 2], [big, 3], [-big, 0]]))
    rows, scores = lists.top(np.array([big, 1.0]), 9)
    assert rows.tolist() == [2, 1] and list(scores) == [int(big) ** 2 + 3, int(big) ** 2 + 2]


def test_collapse_keeps_maximal_conversations(spark):
    a, b, c = ("user", "hi"), ("assistant", "hello"), ("user", "bye")
    convs = {1: [a], 2: [a, b], 3: [a, b, c], 4: [a, b, c], 5: [b, a], 6: [a, c], 7: [("user", None)],
             8: [(None, "")], 9: [a, b, ("user", "<|im_end|>")], 10: [a] * 600, 11: [a] * 300}
    rows = [(k, 2 * i, r, t, "x") for k, turns in convs.items() for i, (r, t) in enumerate(turns)]
    rows += [(None, 0, "user", "lost", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, pos string")
    got = chat.format_conversations(df).orderBy("conv_id", "segment").collect()
    kept = {}
    for r in got:
        kept.setdefault(r.conv_id, [r.n_turns, r.copies, ""])[2] += r.rendered

    def text(turns):
        return "".join(f"<|im_start|>{r or 'user'}\n{(t or '').replace('<|', '< |')}<|im_end|>\n" for r, t in turns)
    assert kept == {k: [len(convs[k]), n, text(convs[k])] for k, n in ((3, 2), (5, 1), (6, 1), (7, 2), (9, 1), (10, 1))}
    assert max(r.segment for r in got if r.conv_id == 10) == 4
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_chat_with_null_and_equal_turns(spark):
    """Turns without a number, or with one number, are cut every 256 and all kept in order."""
    rows = [(1, None, "user", f"t{i:04}") for i in range(700)] + [(2, 5, "user", "same")] * 1000 + [(3, 5, "user", "same")] * 999
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(5)
    got = chat.format_conversations(df).orderBy("conv_id", "segment").collect()
    assert [(r.conv_id, r.segment, r.n_turns) for r in got] == [(1, k, 700) for k in range(3)] + [(2, k, 1000) for k in range(4)]

    def text(of):
        return "".join(f"<|im_start|>user\n{t}<|im_end|>\n" for t in of)
    assert "".join(r.rendered for r in got if r.conv_id == 1) == text(f"t{i:04}" for i in range(700))
    assert "".join(r.rendered for r in got if r.conv_id == 2) == text(["same"] * 1000)
