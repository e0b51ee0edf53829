"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

The index holds every word of a bounded sample of labelled documents, weighted
by idf and by how much the word tells of the label.  The largest weight of each
word in a block of examples bounds the block's scores, so blocks that cannot hold
one of the k nearest are never read.  The nearest vote, and are the evidence.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes_batches, hash_unit, ragged, saved
from .langid import words_of

BLOCK = 64
LONG_WORD = 8  # letters
COMMON = 512  # terms with long lists, held as a dense matrix
BATCH = 128  # queries
FIRST = 3  # blocks read before the others are held against the kth score
FLOOR, LEAST_CHI2, SCALE = 0.1, 6.0, 10.0  # weight of a word by its dependence on the label, see ``term_weights``
PIECE_BYTES = 1 << 19  # text scored at a time
ROUGH = 1e-4  # far above the rounding of a sum in single precision


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """The kth largest of every row, 0 where there are fewer."""
    at = values.shape[1] - k
    return np.partition(values, at, axis=1)[:, at] if at >= 0 else np.zeros(len(values), dtype=values.dtype)


class BlockMaxIndex:
    """Unit vectors of labelled examples, searched for the exact k nearest.

    Examples lie in blocks of 64.  The ``COMMON`` longest posting lists are cut at
    the blocks, with the largest weight of each in every block; they hold most
    examples, so they lie as a dense matrix.  The other lists are about as short
    as such a table of maxima would be, and are read: their sums, exact, and the
    maxima of the long ones bound every block.  A query multiplies the ``FIRST``
    blocks of largest bound, and then those others whose bound can reach its kth
    score.  Weights are kept in single precision and summed in double;
    ``blocks_read`` and ``blocks_asked`` count.
    """

    def __init__(self, ids: list, toxic: np.ndarray, rows: list[np.ndarray], values: list[np.ndarray], terms: int):
        # similar examples share a block, so that its bounds are tight: order by heaviest terms
        top = [tuple(r[np.argsort(-v, kind="stable")[:3]].tolist()) for r, v in zip(rows, values)]
        at = sorted(range(len(rows)), key=lambda i: (top[i], ids[i]))
        self.ids, self.toxic = [ids[i] for i in at], toxic[at]
        rows, values = [rows[i] for i in at], [values[i] for i in at]
        self.n = len(rows)
        self.blocks_read = self.blocks_asked = 0
        term = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        example = np.repeat(np.arange(self.n, dtype=np.int32), [len(r) for r in rows])
        weight = (np.concatenate(values) if values else np.zeros(0)).astype(np.float32)
        uses = np.bincount(term, minlength=terms)
        common = np.argsort(-uses, kind="stable")[:COMMON]
        common = common[uses[common] > 0]
        self.place = np.full(terms, -1, dtype=np.int32)  # column of a common term
        self.place[common] = np.arange(len(common))
        column = self.place[term]
        self.dense = np.zeros((self.n, len(common)), dtype=np.float32)
        self.dense[example[column >= 0], column[column >= 0]] = weight[column >= 0]
        self.edges = np.arange(0, self.n, BLOCK)
        self.bound = (np.maximum.reduceat(self.dense, self.edges, axis=0) if self.n else self.dense).T.astype(float)
        term, example, weight = term[column < 0], example[column < 0], weight[column < 0]
        order = np.argsort(term, kind="stable")  # examples ascend already
        self.example, self.weight = example[order], weight[order]
        self.start = np.searchsorted(term[order], np.arange(terms + 1)).astype(np.int32)

    def _rarer(self, row: np.ndarray, value: np.ndarray) -> np.ndarray:
        size = self.start[row + 1] - self.start[row]
        at = ragged(self.start[row], size)
        return np.bincount(self.example[at], weights=self.weight[at] * np.repeat(value, size), minlength=self.n)

    def _multiply(self, asked: np.ndarray, query: np.ndarray, rare: np.ndarray, both: np.ndarray) -> None:
        """Scores of the examples in the asked blocks [query, block], to single precision: a block for all its queries."""
        for b, lo in enumerate(self.edges.tolist()):
            some = np.flatnonzero(asked[:, b])
            if len(some):
                hi = min(lo + BLOCK, self.n)
                both[some, lo:hi] = rare[some, lo:hi] + query[some] @ self.dense[lo:hi].T
        self.blocks_read += int(asked.sum())

    def nearest_of(self, rows: list[np.ndarray], values: list[np.ndarray], k: int,
                   without: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of every query, ``BATCH`` queries at a time."""
        if not self.n:
            return [(np.zeros(0, np.int64), np.zeros(0))] * len(rows)
        out, width = [], len(self.edges) * BLOCK
        for lo in range(0, len(rows), BATCH):
            some = range(lo, min(lo + BATCH, len(rows)))
            query, rare = np.zeros((len(some), self.dense.shape[1])), np.zeros((len(some), self.n))
            for j, i in enumerate(some):
                column = self.place[rows[i]]
                query[j, column[column >= 0]] = values[i][column >= 0]
                rare[j] = self._rarer(rows[i][column < 0], values[i][column < 0])
            single, both = query.astype(np.float32), np.zeros((len(some), width), dtype=np.float32)
            if without is not None:
                left_out = np.array([without[i] for i in some])
                out_of = np.flatnonzero(left_out >= 0)
                rare[out_of, left_out[out_of]] = -np.inf
            bound = np.maximum.reduceat(rare, self.edges, axis=1) + query @ self.bound
            first = np.zeros(bound.shape, dtype=bool)
            top = np.argpartition(-bound, min(FIRST, bound.shape[1]) - 1, axis=1)[:, :FIRST]
            np.put_along_axis(first, top, True, axis=1)
            self._multiply(first, single, rare, both)
            held = np.take_along_axis(both.reshape(len(some), -1, BLOCK), top[:, :, None], axis=1).reshape(len(some), -1)
            need = _kth(held, k) - ROUGH
            self._multiply((bound >= need[:, None]) & (bound > 0) & ~first, single, rare, both)
            self.blocks_asked += bound.size
            able = both[:, :self.n] >= np.maximum(need, np.finfo(np.float32).tiny)[:, None]
            for j in range(len(some)):
                hit = np.flatnonzero(able[j])
                near = both[j, hit]
                hit = hit[near >= _kth(near[None], k)[0] - ROUGH]
                score = rare[j, hit] + self.dense[hit].astype(float) @ query[j]
                best = np.lexsort((hit, -np.round(score, 12)))[:k]
                out.append((hit[best], score[best]))
        return out

    def nearest(self, row: np.ndarray, value: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the k nearest with a positive cosine; ties go to the earlier example."""
        return self.nearest_of([row], [value], k, [without])[0]


def vote(near: np.ndarray, toxic: np.ndarray, base: float, k: int) -> float:
    """Share of the votes for toxic; nearer examples weigh more, and missing neighbours vote as the base rate."""
    weight = near ** 2 / (1.05 - np.minimum(near, 1.0))
    return float((weight @ toxic + 0.02 * k * base) / (weight.sum() + 0.02 * k))


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, float]:
    """Slopes and intercept of a logistic fit on the columns of ``x``, the slopes held to an equal
    share of 1 and the intercept to 0; a falling slope becomes flat."""
    x = np.column_stack([x, np.ones(len(x))])
    to = np.append(np.full(x.shape[1] - 1, 1 / (x.shape[1] - 1)), 0.0)
    pull = np.append(np.ones(len(to) - 1), 0.1)
    fit = np.append(to[:-1], 0.0)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ fit, -30, 30)))
        g = x.T @ (p - y) + pull * (fit - to)
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(pull)
        fit = fit - np.clip(np.linalg.solve(h, g), -0.5, 0.5)
    return np.maximum(fit[:-1], 0.0), float(fit[-1])


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


class Model:
    """Terms with idf and class weight, the index of examples, and the calibration of their votes."""

    def __init__(self, factor: np.ndarray, k: int):
        self.factor, self.k = factor, k  # idf times class weight of every term
        self.index, self.base, self.slopes, self.intercept = None, 0.0, np.zeros(1), -30.0
        self.empty = 0.0

    def vector(self, row: np.ndarray, tf: np.ndarray) -> np.ndarray:
        value = (1 + np.log(tf, dtype=float)) * self.factor[row]
        norm = np.sqrt(value @ value)
        return value / norm if norm > 0 else value

    def _asked(self, rows: list[np.ndarray], tfs: list[np.ndarray], ids: list | None = None) -> tuple[list, np.ndarray]:
        """(neighbours, logit of their vote) of texts with words; ``ids`` are left out of their own vote."""
        own = None
        if ids is not None:
            place = {d: i for i, d in enumerate(self.index.ids)}
            own = [place[d] for d in ids]
        near = self.index.nearest_of(rows, [self.vector(r, t) for r, t in zip(rows, tfs)], self.k, own)
        return near, _logit(np.array([vote(c, self.index.toxic[best], self.base, self.k) for best, c in near]))[:, None]

    def learn(self, ids: list, toxic: np.ndarray, rows: list[np.ndarray], tfs: list[np.ndarray]) -> None:
        """Index the examples and calibrate on votes that leave each example itself out."""
        self.base = float((toxic.sum() + 0.5) / (len(toxic) + 1))

        def rate(some: np.ndarray) -> float:
            return float((toxic[some].sum() + self.base) / (some.sum() + 1))

        bare = np.array([len(r) == 0 for r in rows], dtype=bool)
        self.empty = rate(bare)  # texts without a word have no neighbours: the rate among such examples
        full = np.flatnonzero(~bare)
        self.index = BlockMaxIndex([ids[i] for i in full], toxic[full], [rows[i] for i in full],
                                   [self.vector(rows[i], tfs[i]).astype(np.float32) for i in full], len(self.factor))
        if len(full) and 0 < toxic[full].sum() < len(full):
            votes = [self._asked([rows[i] for i in some], [tfs[i] for i in some], [ids[i] for i in some])[1]
                     for some in np.array_split(full, -(-len(full) // 1024))]
            self.slopes, self.intercept = logistic(np.concatenate(votes), toxic[full].astype(float))
        else:
            # one label only: nothing to calibrate on
            self.slopes, self.intercept = np.zeros(1), float(_logit(np.array([rate(~bare)]))[0])

    def scores(self, rows: list[np.ndarray], tfs: list[np.ndarray]) -> tuple[np.ndarray, dict]:
        """Scores of many texts, and text -> (examples, cosines) of its neighbours."""
        scores, found = np.full(len(rows), self.empty), {}
        some = [i for i, r in enumerate(rows) if len(r)] if self.index is not None else []
        if some:
            near, votes = self._asked([rows[i] for i in some], [tfs[i] for i in some])
            scores[some] = 1 / (1 + np.exp(-np.clip(votes @ self.slopes + self.intercept, -30, 30)))
            found = dict(zip(some, near))
        return scores, found

    def score(self, rows: list[np.ndarray], tfs: list[np.ndarray]) -> tuple[np.ndarray, list[tuple[list, list, list]]]:
        """Scores and (ids, cosines, labels) of the neighbours of many texts."""
        scores, found = self.scores(rows, tfs)
        evidence = [([], [], [])] * len(rows)
        for i, (best, cosine) in found.items():
            evidence[i] = ([self.index.ids[b] for b in best], cosine.tolist(), self.index.toxic[best].tolist())
        return scores, evidence


def _signature(words: set[str]) -> int:
    """A hash of the three long words with the smallest hashes: near copies mostly share it,
    other texts, though they share some words, do not."""
    some = [w for w in words if len(w) >= LONG_WORD]
    some = some if len(some) >= 3 else words
    low = heapq.nsmallest(3, ((zlib.crc32(w.encode()), w) for w in some))
    return zlib.crc32(" ".join(w for _, w in low).encode())


def _distinct_words(df: DataFrame) -> DataFrame:
    """(word, group, toxic), once per document, of (text, toxic) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in as_bytes_batches(batch.column(0), PIECE_BYTES):
                sets = [set(words_of(t)) for t in batch.column(0).slice(lo, hi - lo).to_pylist()]
                sizes = list(map(len, sets))
                group = np.repeat([_signature(s) for s in sets], sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chain.from_iterable(sets), pa.string()), pa.array(group, pa.int64()),
                     pa.array(np.repeat(batch.column(1).to_numpy()[lo:hi], sizes), pa.int32())],
                    names=["word", "group", "toxic"])
    return df.mapInArrow(run, "word string, group long, toxic int")


def term_weights(found: DataFrame) -> DataFrame:
    """(word, weight) of every word in (word, group, toxic): the class weight inside the TF-IDF cosine.

    A word weighs ``FLOOR``, and more the more its presence depends on the label:
    by the root of chi-squared (with continuity correction) above ``LEAST_CHI2``.
    No word is left out.  Documents of one group of copies count once per word,
    else every word of a copied document would tell.
    """
    n, t = (found.groupBy("group").agg(F.max("toxic").alias("toxic"))
            .agg(F.count("*").cast("double"), F.coalesce(F.sum("toxic"), F.lit(0)).cast("double")).first())
    counts = found.groupBy("word").agg(F.count("*").cast("double").alias("df"),
                                       F.sum("toxic").cast("double").alias("a"))
    if not 0 < t < n:  # one label only: every word alike
        return counts.select("word", F.lit(FLOOR).alias("weight"))
    gap = F.greatest(F.abs(F.col("a") * n - F.col("df") * t) - n / 2, F.lit(0.0))
    free = t * (n - t) * F.col("df") * (n - F.col("df"))
    chi2 = F.when(free > 0, gap * gap * n / F.when(free > 0, free)).otherwise(0.0)  # a word of all groups tells nothing
    return counts.select("word", (F.sqrt(F.greatest(chi2 - LEAST_CHI2, F.lit(0.0))) / SCALE + FLOOR).alias("weight"))


def _cells(texts: list[str | None], place: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count), ascending, of the terms in whole texts."""
    parts = [words_of(t) for t in texts]
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    term = np.fromiter(map(place.get, chain.from_iterable(parts), repeat(-1)), dtype=np.int64, count=int(sizes.sum()))
    doc, width = np.repeat(np.arange(len(parts)), sizes)[term >= 0], max(len(place), 1)
    cell, tf = np.unique(doc * width + term[term >= 0], return_counts=True)
    return *np.divmod(cell, width), tf


def _vectors(texts: list[str | None], place: dict[str, int]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Terms, ascending, and their counts, of every whole text."""
    doc, row, tf = _cells(texts, place)
    cuts = np.searchsorted(doc, np.arange(1, len(texts)))
    return np.split(row.astype(np.int32), cuts), np.split(tf.astype(np.float32), cuts)


def _document_counts(texts: DataFrame, words: Broadcast) -> pa.Table:
    """(term, n): in how many rows each word of ``words`` occurs; at most one row a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {w: i for i, w in enumerate(words.value)}
        n = np.zeros(len(place), dtype=np.int64)
        for batch in batches:
            for lo, hi in as_bytes_batches(batch.column(0), PIECE_BYTES):
                n += np.bincount(_cells(batch.column(0).slice(lo, hi - lo).to_pylist(), place)[1], minlength=len(n))
        term = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(n[term])], names=["term", "n"])

    return texts.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()


def _learned(docs: DataFrame, labels: DataFrame, teaches: Column, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", max_examples: int = 12_000, k: int = 15) -> tuple[Broadcast, Broadcast]:
    """The words of the examples and the model, for every task; see ``score_documents`` for the arguments."""
    base = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("id"))
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
             .where(F.col("toxic").isin(0, 1) & F.col("id").isNotNull() & teaches)
             .groupBy("id").agg(F.max("toxic").alias("toxic")))
    n = known.count()
    known = known.where(hash_unit(F.col("id")) < max_examples / max(n, 1))
    examples = saved(base.join(known, "id").dropDuplicates(["id"]).select("text", "id", "toxic"), "examples")
    found = saved(_distinct_words(examples.select("text", "toxic")).groupBy("word", "group")
                  .agg(F.max("toxic").alias("toxic")), "words")
    weighed = term_weights(found).toArrow().sort_by("word")  # the words of at most about max_examples texts
    context = docs.sparkSession.sparkContext
    words = context.broadcast(weighed.column("word").to_pylist())
    weight = weighed.column("weight").to_numpy().astype(float)
    del weighed
    place = {w: i for i, w in enumerate(words.value)}
    counts, seen = _document_counts(base.select("text"), words), np.zeros(len(place))
    seen[counts.column("term").to_numpy()] = counts.column("n").to_numpy()
    model = Model((np.log((1 + base.count()) / (1 + seen)) + 1) * weight, k)
    taught = examples.orderBy("id").toArrow()  # about max_examples rows
    ids, toxic = taught.column("id").to_pylist(), taught.column("toxic").to_numpy().astype(float)
    parts = [_vectors(texts.slice(lo, hi - lo).to_pylist(), place) for texts in taught.column("text").chunks
             for lo, hi in as_bytes_batches(texts)]
    del taught  # the driver holds the texts no longer than it must
    if parts:
        model.learn(ids, toxic, [r for rows, _ in parts for r in rows], [t for _, tfs in parts for t in tfs])
    del parts
    return words, context.broadcast(model)


def score_documents(docs: DataFrame, labels: DataFrame, teaches: Column, id_col: str = "doc_id",
                    text_col: str = "text", label_col: str = "toxic", max_examples: int = 12_000,
                    k: int = 15) -> DataFrame:
    """(id, score, predicted, neighbours) for every whole text of ``docs``.

    ``labels`` has (id, label 0 or 1); only labelled documents where ``teaches``
    (a condition on ``id_col``) holds are learned from, and of those about
    ``max_examples``, chosen by a hash of the id: the index, which every task
    holds, does not grow with the input.  Every word of the examples is a term;
    words that no example holds are in no vector.  Document frequencies are
    counted over all documents; a term's idf is multiplied by its class weight
    (``term_weights``).  ``neighbours`` are the ``k`` examples nearest by cosine
    (id, cosine, label), and ``score`` is their distance-weighted vote, calibrated.
    A null, empty or wordless text, or one without any term, scores the rate of
    toxic ones among such examples.  Without labels every
    score is 0.  Rows with a null id are scored; null labels and null label ids
    teach nothing, a document labelled twice with different values counts as
    toxic; repeated rows come back as given.  No documents give no rows, other
    columns are not read.
    """
    words, shared = _learned(docs, labels, teaches, id_col, text_col, label_col, max_examples, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, place = shared.value, {w: i for i, w in enumerate(words.value)}
        for batch in batches:
            for lo, hi in as_bytes_batches(batch.column(0), PIECE_BYTES):
                texts, ids = (c.slice(lo, hi - lo) for c in batch.columns)
                score, evidence = model.score(*_vectors(texts.to_pylist(), place))
                near = [[{"id": i, "cosine": c, "toxic": int(y)} for i, c, y in zip(*e)] for e in evidence]
                kinds = pa.list_(pa.struct([("id", ids.type), ("cosine", pa.float64()), ("toxic", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(near, kinds)],
                    names=["id", "score", "predicted", "neighbours"])

    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("id"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, score double, predicted int, "
                                f"neighbours array<struct<id:{kind},cosine:double,toxic:int>>")


def keep_clean(docs: DataFrame, labels: DataFrame, teaches: Column, text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that ``score_documents`` does not predict toxic.

    Each row goes by its own text, whatever its id; no evidence is made.
    """
    words, shared = _learned(docs, labels, teaches, text_col=text_col, **kw)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, place = shared.value, {w: i for i, w in enumerate(words.value)}
        for batch in batches:
            texts = batch.column(at).cast(pa.string())
            for lo, hi in as_bytes_batches(texts, PIECE_BYTES):
                score = model.scores(*_vectors(texts.slice(lo, hi - lo).to_pylist(), place))[0]
                yield batch.slice(lo, hi - lo).filter(pa.array(score < 0.5))

    return docs.mapInArrow(run, docs.schema)
