"""Exact distinct counts that merge (A4, A8, U2): chunked bitmaps of integer ids.

A set of ids is a row per chunk of 32,768 ids that holds any, with one bit an
id.  Sets of several batches merge with OR, shared ids are the AND, and counts
are sums over chunks; all are hash-partitioned aggregates with a map-side part.
Ids should be dense (``recommend.index_ids`` makes them so): an id alone in its
chunk takes a whole bitmap of 4 KB.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_bitmaps(df: DataFrame, ids: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., what, chunk, bits): the ids of each column of ``ids``, per group of ``by``.  Null ids count as none."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("what"), F.col(c).cast("long").alias("id")) for c in ids]))
    rows = df.select(*by, each.alias("e")).where("e.id IS NOT NULL")
    return rows.groupBy(*by, "e.what", F.bitmap_bucket_number("e.id").alias("chunk")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("e.id")).alias("bits"))


def merged(bitmaps: DataFrame) -> DataFrame:
    """(what, chunk, bits) of everything in ``bitmaps``, whatever batches or groups it comes from."""
    return bitmaps.groupBy("what", "chunk").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_ids(bitmaps: DataFrame, ids: Sequence[str]) -> DataFrame:
    """One row: ``distinct_<id>`` of every column, over all batches."""
    n = merged(bitmaps).select("what", F.bitmap_count("bits").alias("n"))
    return n.agg(*[F.coalesce(F.sum(F.when(F.col("what") == c, F.col("n"))), F.lit(0)).alias(f"distinct_{c}") for c in ids])


def overlap_counts(df: DataFrame, part_col: str, id_col: str, parts: Sequence) -> DataFrame:
    """(part_a, part_b, overlap) for every pair of ``parts`` (a < b): how many ids both hold.

    Each part's bitmaps go to the pairs it is in; a chunk that both sides of a
    pair hold is ANDed.  No row meets another row's copy: no join.
    """
    pairs = list(combinations(sorted(parts), 2))
    kind = df.schema[part_col].dataType.simpleString()
    if not pairs:
        return df.sparkSession.createDataFrame([], f"part_a {kind}, part_b {kind}, overlap long")
    every = F.array(*[F.struct(F.lit(a).cast(kind).alias("part_a"), F.lit(b).cast(kind).alias("part_b")) for a, b in pairs])
    own = F.filter(every, lambda p: (p["part_a"] == F.col(part_col)) | (p["part_b"] == F.col(part_col)))
    sides = id_bitmaps(df.where(F.col(part_col).isin(list(parts))), [id_col], [part_col]).select(
        F.explode(own).alias("p"), "chunk", "bits").select("p.*", "chunk", "bits")
    both = (sides.groupBy("part_a", "part_b", "chunk").agg(F.count("*").alias("n"), F.bitmap_and_agg("bits").alias("bits"))
            .where("n = 2").select("part_a", "part_b", F.bitmap_count("bits").alias("n")))
    none = df.sparkSession.createDataFrame([(a, b, 0) for a, b in pairs], f"part_a {kind}, part_b {kind}, n long")
    return both.union(none).groupBy("part_a", "part_b").agg(F.sum("n").alias("overlap"))
