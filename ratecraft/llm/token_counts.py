"""Token counts without tokens: a Viterbi pass that carries a score and a count.

An Aho-Corasick automaton lists the vocabulary pieces inside the new words of a
batch; dynamic programming over all of them at once keeps, for every position,
the best score and the number of pieces on its path.  Ties go as in the unigram
tokenizer: of equal scores the path whose last piece starts first stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordMemo, as_bytes_batches, segment_sums

SPACE_MARK = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value: an unknown character scores this far below the worst piece


class Pieces:
    """A unigram vocabulary: ``scores`` of pieces, byte pieces for what no piece covers."""

    def __init__(self, scores: dict[str, float], byte_fallback: bool, worst: float | None = None):
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in scores):
            raise ValueError("a piece holds a space mark after another character: words are not independent")
        self.byte_fallback = byte_fallback
        self.unknown = (min(scores.values()) if worst is None else worst) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        pieces = list(scores)
        for i, p in enumerate(pieces):
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        self.size = np.array([len(p) for p in pieces], dtype=np.int64)
        self.score = np.array([scores[p] for p in pieces], dtype=np.float64)

    def solve(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(pieces of each word on its best path, ones); words are cut before space marks."""
        by_size = sorted(range(len(words)), key=lambda i: len(words[i]))
        counts = np.zeros(len(words), dtype=np.int64)
        lo = 0
        while lo < len(words):  # words of similar length run together
            hi, top, total = lo, max(8, 2 * len(words[by_size[lo]])), 0
            while hi < len(words) and len(words[by_size[hi]]) <= top and (hi == lo or total < 1 << 20):
                total += len(words[by_size[hi]])
                hi += 1
            counts[by_size[lo:hi]] = self._viterbi([words[i] for i in by_size[lo:hi]])
            lo = hi
        return counts, np.ones(len(words), dtype=np.int64)

    def _viterbi(self, words: list[str]) -> np.ndarray:
        lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        text = "".join(words)
        ends = np.cumsum(lens)
        n = len(text)
        got = np.fromiter(chain.from_iterable(self.automaton.iter(text)), dtype=np.int64).reshape(-1, 2)
        end, start = got[:, 0] + 1, got[:, 0] + 1 - self.size[got[:, 1]]
        score, pieces = self.score[got[:, 1]], np.ones(len(got), dtype=np.int64)
        word_start = np.repeat(ends - lens, lens)  # of each character
        inside = start >= word_start[end - 1]
        end, start, score, pieces = end[inside], start[inside], score[inside], pieces[inside]
        single = np.zeros(n, dtype=bool)
        single[start[end - start == 1]] = True
        bare = np.flatnonzero(~single)
        if len(bare):
            size = (np.array([len(text[i].encode("utf-8")) for i in bare.tolist()], dtype=np.int64)
                    if self.byte_fallback else np.ones(len(bare), dtype=np.int64))
            end, start = np.concatenate([end, bare + 1]), np.concatenate([start, bare])
            score = np.concatenate([score, np.full(len(bare), self.unknown)])
            pieces = np.concatenate([pieces, size])
        depth = end - word_start[end - 1]
        at = np.lexsort((start, end, depth))
        end, start, score, pieces, depth = (x[at] for x in (end, start, score, pieces, depth))
        # state of position p of word w at index p + w: each word has one position more than characters
        word = np.repeat(np.arange(len(words)), lens)[end - 1]
        end, start = end + word, start + word
        best = np.zeros(n + len(words))
        count = np.zeros(n + len(words), dtype=np.int64)
        cuts = np.searchsorted(depth, np.arange(1, int(lens.max(initial=0)) + 2))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            to, first = _runs(end[lo:hi])
            new = best[start[lo:hi]] + score[lo:hi]
            top = np.maximum.reduceat(new, first)
            is_top = new == np.repeat(top, np.diff(np.concatenate([first, [hi - lo]])))
            where = np.minimum.reduceat(np.where(is_top, np.arange(hi - lo), hi - lo), first)
            best[to] = top
            count[to] = count[start[lo:hi][where]] + pieces[lo:hi][where]
        return count[ends + np.arange(len(words))]


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate([[True], np.diff(sorted_values) != 0]))
    return sorted_values[first], first


@lru_cache(maxsize=2)
def load_pieces(path: str) -> Pieces:
    """The pieces and scores of a sentencepiece file, read as a unigram vocabulary."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(sp.get_piece_size())
             if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    every = [sp.get_score(i) for i in range(sp.get_piece_size())]
    return Pieces({sp.id_to_piece(i): sp.get_score(i) for i in plain}, any(map(sp.is_byte, range(len(every)))),
                  min(every))


WORD = re.compile(f"{SPACE_MARK}*[^{SPACE_MARK}]+|{SPACE_MARK}+")


def words_of(text: str) -> list[str]:
    """The marked text, cut before every space mark that follows another character."""
    return WORD.findall(SPACE_MARK + text.replace(" ", SPACE_MARK)) if text else []


def token_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 out: str = "n_tokens") -> DataFrame:
    """(id, n_tokens): pieces of the best segmentation of every whole text.

    The text is taken as it is, with a space mark in front and one for every
    space.  No piece runs from another character into a space mark, so the best
    path of a text is the best paths of its words, and scores are whole numbers,
    so sums and ties are exact.  Null and empty texts count 0; null and repeated
    ids pass through; no rows give no rows; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordMemo(load_pieces(path).solve)
        for batch in batches:
            for lo, hi in as_bytes_batches(batch.column(1)):
                parts = [words_of(t) if t else [] for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                words = list(chain.from_iterable(parts))
                flat = memo.values(memo.index(words))[0] if words else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(segment_sums(flat, list(map(len, parts))))],
                    names=["id", out])

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {out} long")
