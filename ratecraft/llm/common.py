"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.session import work_dir


def saved_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``saved``, and the folder, for whoever discards it."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(f"{path}/rows")
    return spark.read.schema(df.schema).parquet(f"{path}/rows"), path


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage and survives lost executors; unlike a cache it holds no
    executor memory.  The folder is left to whoever owns the checkpoint root,
    because the returned DataFrame still reads it.
    """
    return saved_at(df, name)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``saved_at`` that no DataFrame in use reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def held_out(doc_id: Column) -> Column:
    """The evaluation fold: crc32 of the id as text, modulo 5, is 0 (null id: not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def hash_unit(col: Column) -> Column:
    """A reproducible number in [0, 1) per value, for hash sampling."""
    return F.pmod(F.xxhash64(F.lit("sample"), col), F.lit(1 << 40)) / F.lit(float(1 << 40))


def as_bytes_batches(texts: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a string array holding about ``limit`` bytes each (one row at least)."""
    lens = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    lo, size = 0, 0
    for i, n in enumerate(lens.tolist()):
        if size and size + n > limit:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(lens):
        yield lo, len(lens)


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Positions start..start+len-1 of every row, one after another."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(lens)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lens), lens)


class WordMemo:
    """word -> row of a value store, filled in bulk by ``solve`` and bounded in size.

    ``solve(words)`` gets the distinct unknown words of one piece of work and
    returns (flat values, lengths).  Once ``limit`` words are held the memo is
    emptied before the next piece, so memory is bounded whatever the corpus.
    Words longer than ``longest`` characters are solved but not kept.
    """

    def __init__(self, solve, limit: int = 500_000, longest: int = 64, dtype=np.int64):
        self.solve, self.limit, self.longest, self.dtype = solve, limit, longest, dtype
        self._clear()

    def _clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, dtype=self.dtype)
        self.used = 0
        self.lens = np.zeros(1 << 15, dtype=np.int64)
        self.starts = np.zeros(1 << 15, dtype=np.int64)
        self.n = 0
        self.long: list[str] = []

    def _add(self, words: list[str]) -> None:
        flat, lens = self.solve(words)
        n, m = len(words), len(flat)
        while self.used + m > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.n + n > len(self.lens):
            self.lens = np.concatenate([self.lens, np.zeros_like(self.lens)])
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.flat[self.used:self.used + m] = flat
        self.lens[self.n:self.n + n] = lens
        self.starts[self.n:self.n + n] = self.used + np.cumsum(lens) - lens
        self.rows.update(zip(words, range(self.n, self.n + n)))
        self.long += [w for w in words if len(w) > self.longest]
        self.n += n
        self.used += m

    def index(self, words: list[str]) -> np.ndarray:
        """Row of every word (see ``values``); valid until the next call."""
        if len(self.rows) > self.limit or self.used > 16 * self.limit:
            self._clear()
        elif self.long:
            for w in self.long:
                self.rows.pop(w, None)
            self.long = []
        out = np.fromiter(map(self.rows.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        at = np.flatnonzero(out < 0)
        if len(at):
            new = [words[i] for i in at.tolist()]
            self._add(list(dict.fromkeys(new)))
            out[at] = np.fromiter(map(self.rows.__getitem__, new), dtype=np.int64, count=len(new))
        return out

    def values(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Concatenated values of the indexed words, and how many each word has."""
        lens = self.lens[index]
        return self.flat[ragged(self.starts[index], lens)], lens


def segment_sums(values: np.ndarray, counts: Iterable[int]) -> np.ndarray:
    """Sum of each run of ``counts[i]`` rows of ``values`` (0 for an empty run)."""
    ends = np.cumsum(np.asarray(counts, dtype=np.int64))
    total = np.concatenate([np.zeros((1, *values.shape[1:]), values.dtype), np.cumsum(values, axis=0)])
    return total[ends] - total[np.concatenate([[0], ends[:-1]])]


def numbered(rows: DataFrame, name: str = "copy") -> DataFrame:
    """The rows with a number from 0 that differs between equal rows.

    Equal rows are counted map-side first; large counts are cut into runs of
    4,096 that are spread before they are written out again, so no task gets all
    rows of a value.
    """
    cols = rows.columns
    counted = rows.groupBy(*cols).agg(F.count("*").alias("_times"))
    runs = counted.select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("_times") - 1) / 4096))).alias("_run"))
    spread = runs.repartition(*cols, "_run")
    last = F.least(F.col("_times") - 1, F.col("_run") * 4096 + 4095)
    return spread.select(*cols, F.explode(F.sequence(F.col("_run") * 4096, last)).alias(name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
