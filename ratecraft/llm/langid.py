"""Language identification by segmentation-marginalised unigrams.

The pieces are a fixed public vocabulary; each language has its own piece
probabilities.  A word's probability is the sum over all its segmentations (a
forward pass); pieces never cross words, so a text's is the product of its words'.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordMemo, as_bytes_batches, hash_unit, segment_sums
from .token_counts import SPACE_MARK

UNDETERMINED = "und"
WORD = re.compile(r"[^\W\d_]+")
LONGEST_TAUGHT = 48  # longer letter runs teach in pieces of this length
PIECE_BYTES = 1 << 19  # text decided at a time


def words_of(text: str | None) -> list[str]:
    """Lower-case letter runs of the text (runs with other number signs are cleaned later)."""
    return WORD.findall(text.lower()) if text else []


def letter_pieces(path: str) -> list[str]:
    """Lower-case letter pieces of a sentencepiece file, with or without the word mark."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    every = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
    plain = {p for p in every if (p[1:] if p[:1] == SPACE_MARK else p).isalpha() and p == p.lower()}
    return sorted(plain)


class Lattice:
    """All pieces of the vocabulary inside words, as edges between character positions.

    The last piece id stands for a character that no piece of one character covers.
    """

    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        self.size = np.array([len(p) for p in pieces], dtype=np.int64)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, p in enumerate(pieces):
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()

    def edges(self, words: list[str]):
        """(start, end, piece, cuts by depth of end, final position per word, number of positions).

        Word w owns its characters' positions and one more; edges are sorted by depth, then end.
        """
        lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        text, ends = "".join(words), np.cumsum(lens)
        got = np.fromiter(chain.from_iterable(self.automaton.iter(text)), dtype=np.int64).reshape(-1, 2)
        end, piece = got[:, 0] + 1, got[:, 1]
        start = end - self.size[piece]
        first = np.repeat(ends - lens, lens)
        inside = start >= first[end - 1]
        start, end, piece = start[inside], end[inside], piece[inside]
        single = np.zeros(len(text), dtype=bool)
        single[start[end - start == 1]] = True
        bare = np.flatnonzero(~single)
        start, end = np.concatenate([start, bare]), np.concatenate([end, bare + 1])
        piece = np.concatenate([piece, np.full(len(bare), len(self.pieces))])
        depth = end - first[end - 1]
        at = np.lexsort((end, depth))
        start, end, piece, depth = start[at], end[at], piece[at], depth[at]
        word = np.repeat(np.arange(len(words)), lens)[end - 1]
        cuts = np.searchsorted(depth, np.arange(1, int(lens.max(initial=0)) + 2))
        return start + word, end + word, piece, cuts, ends + np.arange(len(words)), len(text) + len(words)


def _groups(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate([[True], np.diff(values) != 0]))
    return values[first], first


def _log_sums(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """log of the sum of exp over each run of rows."""
    top = np.maximum.reduceat(x, first, axis=0)
    size = np.diff(np.concatenate([first, [len(x)]]))
    return top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, size, axis=0)), first, axis=0))


def forward(edges, logp: np.ndarray) -> np.ndarray:
    """Forward log probabilities of every position, for every language."""
    start, end, piece, cuts, _, n = edges
    out = np.zeros((n, logp.shape[1]))
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        to, first = _groups(end[lo:hi])
        out[to] = _log_sums(out[start[lo:hi]] + logp[piece[lo:hi]], first)
    return out


def expected_counts(edges, logp: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Expected uses of every piece, summed over words by ``weight`` [word, language]."""
    start, end, piece, cuts, final, n = edges
    ahead = forward(edges, logp)
    behind = np.full((n, logp.shape[1]), -np.inf)
    behind[final] = 0.0
    for lo, hi in zip(cuts[-2::-1].tolist(), cuts[:0:-1].tolist()):  # ends of falling depth
        s = start[lo:hi]
        at = np.argsort(s, kind="stable")
        to, first = _groups(s[at])
        add = _log_sums((behind[end[lo:hi]] + logp[piece[lo:hi]])[at], first)
        behind[to] = np.logaddexp(behind[to], add)
    word = np.searchsorted(final, end)
    share = np.exp(ahead[start] + logp[piece] + behind[end] - ahead[final][word]) * weight[word]
    return np.stack([np.bincount(piece, weights=share[:, k], minlength=len(logp)) for k in range(logp.shape[1])], 1)


class Model:
    """Languages, priors and piece log probabilities; small (vocabulary x languages)."""

    def __init__(self, languages: list[str], prior: np.ndarray, pieces: list[str], logp: np.ndarray):
        self.languages, self.prior, self.pieces, self.logp = languages, prior, pieces, logp

    def solver(self):
        """word -> its log probability per language and its number of letters."""
        lattice, width = Lattice(self.pieces), len(self.languages) + 1

        def solve(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
            clean = ["".join(filter(str.isalpha, w)) for w in words]
            out = np.zeros((len(words), width))
            out[:, -1] = [len(c) for c in clean]
            todo = sorted((i for i, c in enumerate(clean) if c), key=lambda i: len(clean[i]))
            lo = 0
            while lo < len(todo):  # words of similar length run together
                hi, total, top = lo, 0, max(8, 2 * len(clean[todo[lo]]))
                while hi < len(todo) and len(clean[todo[hi]]) <= top and (hi == lo or total < 1 << 18):
                    total += len(clean[todo[hi]])
                    hi += 1
                edges = lattice.edges([SPACE_MARK + clean[i] for i in todo[lo:hi]])
                out[todo[lo:hi], :-1] = forward(edges, self.logp)[edges[4]]
                lo = hi
            return out.ravel(), np.full(len(words), width)

        return solve


def fit(df: DataFrame, path: str, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        docs_per_language: int = 300, rounds: int = 3) -> Model:
    """Learn piece probabilities by expectation maximisation from labelled documents.

    The sample is bounded: about ``docs_per_language`` whole documents of each
    language, chosen by a hash of the id, so it does not grow with the input;
    its word counts are what comes to the driver.  Rows with a null language or
    text teach nothing; no labelled rows give a model without languages.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    share = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(share)
    if not languages:
        return Model([], np.zeros(0), [], np.zeros((0, 0)))
    # a map literal, not a join: one entry per language
    odds = F.create_map(*chain.from_iterable((F.lit(k), F.lit(docs_per_language / n)) for k, n in share.items()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(k, w[i:i + LONGEST_TAUGHT])
                     for t, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                     for w in words_of(t) if w.isalpha() for i in range(0, len(w), LONGEST_TAUGHT)]
            lang, word = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(word, pa.string())],
                                             names=["lang", "word"])

    sample = rows.where(hash_unit(F.col("id")) < odds[F.col("lang")]).select("text", "lang")
    counts = sample.mapInArrow(count, "lang string, word string").groupBy("word", "lang").count().toPandas()
    pieces = letter_pieces(path)
    lattice = Lattice(pieces)
    words = sorted(set(counts["word"]))
    weight = np.zeros((len(words), len(languages)))
    at = {w: i for i, w in enumerate(words)}
    weight[counts["word"].map(at), counts["lang"].map({k: i for i, k in enumerate(languages)})] = counts["count"]
    chunks = [(lattice.edges([SPACE_MARK + w for w in words[k:k + 20_000]]), weight[k:k + 20_000])
              for k in range(0, len(words), 20_000)]
    logp = np.full((len(pieces) + 1, len(languages)), -np.log(len(pieces) + 1))
    for _ in range(rounds):
        used = sum((expected_counts(e, logp, w) for e, w in chunks), np.zeros_like(logp))
        pooled = used.sum(axis=1, keepdims=True) + 1e-3
        used += 50 * pooled / pooled.sum() + 1e-3  # pieces a language lacks lean on the other languages
        logp = np.log(used / used.sum(axis=0))
    total = sum(share.values())
    return Model(languages, np.log([share[k] / total for k in languages]), pieces, logp)


class Decider:
    """Best language (-1: none) and score of many whole texts; word values are kept in a bounded memo."""

    def __init__(self, model: Model):
        self.model, self.width = model, len(model.languages) + 1
        self.memo = WordMemo(model.solver(), limit=150_000, dtype=np.float64) if model.languages else None

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        best, score = np.full(len(texts), -1), np.zeros(len(texts))
        for lo, hi in as_bytes_batches(texts, PIECE_BYTES):
            parts = [words_of(t) for t in texts.slice(lo, hi - lo).to_pylist()]
            words = list(chain.from_iterable(parts))
            if not words or not self.memo:
                continue
            values = self.memo.values(self.memo.index(words))[0].reshape(-1, self.width)
            sums = segment_sums(values, list(map(len, parts)))
            n = np.maximum(np.array(list(map(len, parts))), 1)[:, None]
            logs = (sums[:, :-1] + self.model.prior) / np.sqrt(n)
            odds = np.exp(logs - logs.max(axis=1, keepdims=True))
            known = sums[:, -1] > 0.5
            best[lo:hi] = np.where(known, logs.argmax(axis=1), -1)
            score[lo:hi] = np.where(known, 1 / odds.sum(axis=1), 0.0)
        return best, score


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for every whole text.

    ``score`` is the posterior of the predicted language, with the evidence of
    n words tempered to that of sqrt(n) words, as words of a text are not
    independent.  Null texts and texts without a letter give ``und`` and 0, as
    does a model without languages; ties go to the first language in order.
    Null and repeated ids pass through; no rows give no rows; only the id and
    the text are read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decide, names = Decider(model), np.array([*model.languages, UNDETERMINED], dtype=object)
        for batch in batches:
            best, score = decide(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names[best].tolist(), pa.string()),
                                              pa.array(score)], names=["id", "lang_pred", "score"])

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double")


def keep_known(df: DataFrame, model: Model, least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns as they are, whose text has a language with a score of ``least`` or more.

    Decisions are those of ``predict``, each row's by its own text, whatever its id.
    """
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decide = Decider(model)
        for batch in batches:
            best, score = decide(batch.column(at).cast(pa.string()))
            yield batch.filter(pa.array((best >= 0) & (score >= least)))

    return df.mapInArrow(run, df.schema)
