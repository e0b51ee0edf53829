"""Byte-level BPE: encode and decode whole texts with a public vocabulary.

Words are merged in bulk: the symbols of all new words of a batch lie in one
flat array, and each round merges the lowest-ranked pair of every word at once,
found by binary search over the sorted pair keys.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WordMemo, as_bytes_batches, ragged

# Fixed value: the split pattern of this vocabulary family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Unicode white space, as \s above matches it.
SPACE = "".join(map(chr, (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
                          0x205F, 0x3000)))
# Letters that are letters in every Unicode version (other scripts are cut less often).
LETTER = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f"
# No pre-token goes on from a non-space to a space or from a letter to a
# non-letter, so a text can be cut there and each piece encoded by itself.
PIECE = re.compile(f"[{SPACE}]*[^{SPACE}{LETTER}]*[{LETTER}]+|[{SPACE}]*[^{SPACE}{LETTER}]+|[{SPACE}]+")
NONE = np.int64(1) << 40


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(256 + hidden.index(b)) if b in hidden else chr(b) for b in range(256)]


class Vocabulary:
    """Merge table and token bytes of a byte-level BPE file (JSON of the tokenizers library)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        symbols = byte_symbols()
        byte_of = {c: b for b, c in enumerate(symbols)}
        self.first = np.array([ids[c] for c in symbols], dtype=np.int64)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.size = max([*ids.values(), *self.special.values()]) + 1
        self.bytes = [b""] * self.size
        for token, i in ids.items():
            plain = all(c in byte_of for c in token)
            self.bytes[i] = bytes(byte_of[c] for c in token) if plain else token.encode("utf-8")
        for token, i in self.special.items():
            self.bytes[i] = token.encode("utf-8")
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([ids[a] * self.size + ids[b] for a, b in merges], dtype=np.int64)
        at = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[at], at.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in merges], dtype=np.int64)[at]
        self.split = regex.compile(PATTERN)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NONE)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, ids per word); no word may be empty."""
        lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        sym = self.first[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words)), lens)
        last = np.zeros(len(sym), dtype=bool)
        last[np.cumsum(lens) - 1] = True
        rank = np.full(len(sym), NONE, dtype=np.int64)
        inner = np.flatnonzero(~last)
        rank[inner] = self._ranks(sym[inner], sym[inner + 1])
        by_rank = np.empty(len(self.rank), dtype=np.int64)
        by_rank[self.rank] = self.merged
        done_word, done_sym = [], []
        while len(sym):
            starts = np.flatnonzero(np.concatenate([[True], last[:-1]]))
            size = np.diff(np.concatenate([starts, [len(sym)]]))
            low = np.repeat(np.minimum.reduceat(rank, starts), size)
            over = low == NONE
            done_word.append(word[over])
            done_sym.append(sym[over])
            hit = (rank == low) & ~over
            # of overlapping pairs (a a a) every other one merges, from the left
            pos = np.flatnonzero(hit)
            new_run = np.concatenate([[True], np.diff(pos) != 1]) if len(pos) else np.zeros(0, bool)
            run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(pos)), 0)) if len(pos) else pos
            pos = pos[(np.arange(len(pos)) - run_start) % 2 == 0]
            sym[pos] = by_rank[rank[pos]]
            last[pos] = last[pos + 1]
            keep = ~over
            keep[pos + 1] = False
            where = np.cumsum(keep) - 1
            changed = where[pos]
            sym, word, last, rank = sym[keep], word[keep], last[keep], rank[keep]
            before = changed[changed > 0] - 1
            touched = np.concatenate([changed, before[~last[before]]])
            rank[touched] = NONE
            touched = touched[~last[touched]]
            rank[touched] = self._ranks(sym[touched], sym[touched + 1])
        word, sym = np.concatenate(done_word), np.concatenate(done_sym)
        at = np.argsort(word, kind="stable")
        return sym[at], np.bincount(word, minlength=len(words))

    def solve(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per piece) of pieces cut at white space."""
        parts = list(map(self.split.findall, pieces))
        words = list(chain.from_iterable(parts))
        index = dict.fromkeys(words)
        index.update(zip(index, range(len(index))))
        at = np.fromiter(map(index.__getitem__, words), dtype=np.int64, count=len(words))
        ids, lens = self.merge([w.encode("utf-8") for w in index])
        ends = np.cumsum(lens)
        flat = ids[ragged((ends - lens)[at], lens[at])]
        per_part = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        return flat, np.add.reduceat(lens[at], np.cumsum(per_part) - per_part)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Texts to ids through a bounded memo of pieces.

    ``solve`` turns pieces into (ids one after another, ids per piece).
    """

    def __init__(self, solve, special: dict[str, int], limit: int = 500_000):
        self.memo = WordMemo(solve, limit)
        self.special = special
        self.cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after another, ids per text); a special string in a text becomes its id."""
        pieces, counts, marks = [], [], []  # marks: (text, pieces before it, id)
        for i, text in enumerate(texts):
            n = len(pieces)
            if self.cut is not None and any(s in text for s in self.special):
                for part in self.cut.split(text):
                    if part in self.special:
                        marks.append((i, len(pieces), self.special[part]))
                    else:
                        pieces += PIECE.findall(part)
            else:
                pieces += PIECE.findall(text)
            counts.append(len(pieces) - n)
        flat, lens = self.memo.values(self.memo.index(pieces)) if pieces else (np.zeros(0, np.int64),) * 2
        total = np.concatenate([[0], np.cumsum(lens)])
        ends = np.cumsum(np.asarray(counts, dtype=np.int64))
        per_text = np.diff(total[np.concatenate([[0], ends])])
        if marks:
            flat = np.insert(flat, [total[p] for _, p, _ in marks], [x for _, _, x in marks])
            per_text = per_text + np.bincount([i for i, _, _ in marks], minlength=len(texts))
        return flat, per_text


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process, shared by its tasks."""
    vocab = vocabulary(path)
    return Encoder(vocab.solve, vocab.special)


def id_lists(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """(id, ids) batches of (id, text) batches."""
    for batch in batches:
        for lo, hi in as_bytes_batches(batch.column(1), 2 << 20):
            texts = [t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
            flat, counts = encoder(path).encode(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), id_lists(flat, counts)],
                                             names=["id", "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], path: str, ids_col: str, out: str) -> Iterator[pa.RecordBatch]:
    """The batches with the text of their id lists as one column more."""
    table = vocabulary(path).bytes
    for batch in batches:
        texts = [None if x.values is None else
                 b"".join(map(table.__getitem__, x.values.to_numpy(zero_copy_only=False).tolist()))
                 .decode("utf-8", "replace") for x in batch.column(batch.schema.get_field_index(ids_col))]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                         names=[*batch.schema.names, out])


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           decoded: str | None = None) -> DataFrame:
    """(id, ids): the token ids of every whole text, with no tokens added at either end.

    A null text is empty, an empty text has no ids; special strings of the
    vocabulary in a text become their id.  Null and repeated ids pass through,
    an empty table gives no rows, and other columns are not read.  Ids come back
    as int lists; ``path`` must name the vocabulary file on every machine.
    ``decoded`` names a further column that takes the ids decoded again, in the
    same task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = _encoded(batches, path)
        return _decoded(got, path, "ids", decoded) if decoded else got

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>"
    return rows.mapInArrow(run, schema + (f", `{decoded}` string" if decoded else ""))


def decode(df: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of its id lists; bytes that are no UTF-8 become U+FFFD.

    A null list gives a null text, an empty list an empty one; an id outside
    the vocabulary or a null inside a list is an error.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType())])
    return df.mapInArrow(lambda batches: _decoded(batches, path, ids_col, out), schema)
