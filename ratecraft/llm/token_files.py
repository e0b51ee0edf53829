"""Token-id files: ORC in ascending document order, with row indexes and Bloom filters on the ids.

ORC does the work: integer columns are run-length encoded, stripes are read in
parallel, stripe and row-group statistics and the Bloom filters let a lookup by
document id skip all but a few row groups.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import PATTERN, Encoder, byte_symbols, id_lists
from .common import as_bytes_batches

SCHEMA = "doc_id long, n_tokens int, ids array<int>"
PLACED = SCHEMA + ", part int, at long"  # the file's number and how many ids lie before the row in it
FILE_ROWS = 500_000  # a file holds about so many rows at most, where there are more files than partitions


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    """The tokenizers library behind the memo of pieces, one per worker process."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one task, one core
    import regex
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    model, symbols, split = tok.model, dict(enumerate(byte_symbols())), regex.compile(PATTERN)

    def ids_of(word: str) -> list[int]:
        """Ids of one pre-token, by the library's BPE model."""
        mapped = (word.replace(" ", symbols[32]) if word.isascii() and word.isprintable()
                  else word.encode("utf-8").decode("latin-1").translate(symbols))
        return [t.id for t in model.tokenize(mapped)]

    def solve(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [ids_of(p) if p.isalpha() or p[0] == " " and p[1:].isalpha()  # one pre-token, no need to split
               else [i for w in split.findall(p) for i in ids_of(w)] for p in pieces]
        lens = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
        return np.fromiter(chain.from_iterable(got), dtype=np.int64, count=int(lens.sum())), lens

    return Encoder(solve, {t.content: i for i, t in tok.get_added_tokens_decoder().items()}, limit=800_000)


def tokenise(df: DataFrame, path: str, end_id: int) -> DataFrame:
    """``PLACED`` rows of (doc_id, text) rows, in the order given, ``end_id`` last in each list.

    The tokenizers library's model encodes the distinct pieces of the texts, kept
    in a bounded memo; texts are cut where its pre-tokenizer always cuts too.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo, hi in as_bytes_batches(batch.column(1), 1 << 20):
                texts = [t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                flat, counts = _encoder(path).encode(texts)
                ends = np.cumsum(counts)
                flat, counts = np.insert(flat, ends, end_id), counts + 1
                at = before + np.cumsum(counts) - counts
                before += len(flat)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(counts, pa.int32()), id_lists(flat, counts),
                     pa.array([part] * (hi - lo), pa.int32()), pa.array(at, pa.int64())],
                    names=["doc_id", "n_tokens", "ids", "part", "at"])

    return df.mapInArrow(run, PLACED)


def write_token_files(df: DataFrame, out: str, path: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", files: int | None = None, stripe_mb: int = 16,
                      row_index_stride: int = 1000) -> None:
    """Write the token ids of every whole text of ``df`` under ``out``, ascending by document id.

    Files hold consecutive ranges of ids and rows ascend inside a file; each row
    says its file's number and its place there, so the order stays known whatever
    the files are called.  A null text is empty: its list is the end id alone.
    Null ids come first; rows of one id lie in order of a hash of their text, and
    are cut into files by it too, so a hot id fills many files.  Repeated rows are
    all written.  An empty table writes files without rows.  Unless ``files`` says
    it, their number follows from the rows.  ``row_index_stride`` rows (1000 at
    least) share an index entry and a Bloom filter; a stripe takes ``stripe_mb``
    MB before compression.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = files or max(least, -(-df.count() // FILE_ROWS))
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # equal rows of different input partitions differ in "origin", so that they can be cut too
    order = ["doc_id", "mark", "text", "origin"]
    placed = (rows.withColumns({"mark": F.xxhash64("text"), "origin": F.spark_partition_id()})
              .repartitionByRange(n, "doc_id", "mark", "origin").sortWithinPartitions(*order).select("doc_id", "text"))
    (tokenise(placed, path, end_id).write.format("orc")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.create.index", "true").option("orc.row.index.stride", str(row_index_stride))
     .option("orc.stripe.size", str(stripe_mb << 20)).option("orc.compress", "zstd").save(out))


def read_token_files(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row of the files."""
    return spark.read.schema(SCHEMA).orc(out)


def lookup(spark: SparkSession, out: str, doc_ids: list[int]) -> DataFrame:
    """The rows of some documents: the filter reaches the ORC reader, which skips stripes and row groups
    by their statistics and Bloom filters."""
    return read_token_files(spark, out).where(F.col("doc_id").isin(doc_ids))


def _crc32(df: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(2)
            flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            off = ids.offsets.to_numpy() - ids.offsets[0].as_py()
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(off[:-1], off[1:])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(crc, pa.int64()), *batch.columns[3:]],
                names=["doc_id", "n_tokens", "ids_crc32", "part", "at"])
    return df.mapInArrow(run, "doc_id long, n_tokens int, ids_crc32 long, part int, at long")


def positions(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every row: ``start`` counts the ids of all rows before it.

    A row knows its place in its file; sums over the files before, one row a
    file, do the rest.  Rows are neither sorted nor shuffled.
    """
    rows = spark.read.schema(PLACED).orc(out)
    totals = rows.groupBy("part").agg(F.max(F.col("at") + F.col("n_tokens")).alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    starts = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("file_start"))
    return _crc32(rows).join(starts, "part").select(
        "doc_id", (F.col("file_start") + F.col("at")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"),
        "ids_crc32")
