"""SimHash near-duplicates: fingerprints, pigeonhole block join, Hamming check, components.

Texts become 64-bit fingerprints in one pass over the documents; everything
after that works on distinct fingerprints, so copies of one text (even a third
of all rows) are a single node.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved
from .components import connected_components

HASH_SEED = 42
STEP = 1 << 15  # shingles whose bits are counted at a time


def fingerprint(text: str | None, width: int) -> int:
    """Unsigned fingerprint: bit i is set if it is set in over half the shingle hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, HASH_SEED)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest, n = xxhash.xxh64_intdigest, len(words) - width + 1
    lo, hi = starts[:n].tolist(), ends[width - 1:].tolist()
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, n, STEP):
        hashes = np.array([digest(joined[s:e], HASH_SEED) for s, e in zip(lo[k:k + STEP], hi[k:k + STEP])],
                          dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, fp): the fingerprint of every whole text as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), width) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def block_masks(max_bits: int, blocks: int) -> list[int]:
    """Masks of every choice of ``blocks - max_bits`` blocks: fingerprints at most
    ``max_bits`` apart agree on all bits of at least one mask."""
    cuts = [round(i * 64 / blocks) for i in range(blocks + 1)]
    part = [(1 << hi) - (1 << lo) for lo, hi in zip(cuts, cuts[1:])]
    masks = [sum(part[i] for i in pick) for pick in combinations(range(blocks), blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _keys(fp: Column, masks: list[int]) -> Column:
    return F.explode(F.array(*[F.xxhash64(F.lit(i), fp.bitwiseAND(F.lit(m))) for i, m in enumerate(masks)]))


def bucket_links(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Star links that join each component of the fingerprints of one bucket."""
    out: list[tuple[int, int]] = []
    rest = np.unique(fps)
    while len(rest) > 1:
        root, front, rest = int(rest[0]), rest[:1], rest[1:]
        while len(front) and len(rest):
            near = np.zeros(len(rest), dtype=bool)
            for k in range(0, len(front), 256):  # unsigned: bitwise_count takes the absolute value
                apart = np.bitwise_count(front.view(np.uint64)[k:k + 256, None] ^ rest.view(np.uint64)[None, :])
                near |= (apart <= max_bits).any(axis=0)
            front, rest = rest[near], rest[~near]
            out += [(root, int(x)) for x in front]
    return out


def _solve_buckets(rows: DataFrame, max_bits: int) -> DataFrame:
    """(a, b) links from (key, fp) rows whose keys hold a bounded number of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            edge = np.flatnonzero(np.diff(keys)) + 1
            found = [x for part in np.split(fps, edge) if len(part) > 1 for x in bucket_links(part, max_bits)]
            a, b = zip(*set(found)) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy()])
            if len(keys):
                cut = int(np.searchsorted(keys, keys[-1]))  # the last key may go on in the next batch
                yield links(keys[:cut], fps[:cut])
                keys, fps = keys[cut:], fps[cut:]
        yield links(keys, fps)

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.select("key", "fp").repartition(parts, "key").sortWithinPartitions("key")
            .mapInArrow(run, "a long, b long"))


def links(distinct: DataFrame, max_bits: int = 3, bucket_rows: int = 1000) -> DataFrame:
    """(a, b) links joining all fingerprints at most ``max_bits`` apart into their components.

    Level 1 joins on two of five blocks.  A bucket of over ``bucket_rows``
    fingerprints is not solved in one task: its fingerprints go on to a level
    whose keys fix more bits, and at the last level at most 4096 distinct
    fingerprints (12 free bits, for 3 differing ones) can share a key.  Any pair that shares a bucket
    goes on together, so no link is lost and no bucket is capped.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("max_bits must lie between 0 and 4")
    todo, found = distinct.select("fp"), None
    levels = [max_bits + 2, max_bits + 5, 16]
    for blocks in levels:
        masks = block_masks(max_bits, blocks)
        keyed = todo.select("fp", _keys(F.col("fp"), masks).alias("key"))
        sizes = keyed.groupBy("key").count().where("count > 1")
        shared = saved(keyed.join(sizes, "key"), "buckets")
        last = blocks == levels[-1]
        solved = _solve_buckets(shared if last else shared.where(F.col("count") <= bucket_rows), max_bits)
        found = solved if found is None else found.union(solved)
        if last:
            break
        todo = shared.where(F.col("count") > bucket_rows).select("fp").distinct()
        if todo.isEmpty():
            break
    return found


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    max_bits: int = 3) -> DataFrame:
    """(id, fp, component): every row with its fingerprint and the smallest id of its group.

    ``width`` words make a shingle; fingerprints link at ``max_bits`` or fewer
    differing bits.  Null, empty and blank texts have fingerprint zero and link
    like any other; texts of fewer words than a shingle hash as a whole.  Rows
    with a null id belong to groups but never name one, unless the whole group
    has null ids (component null).  Repeated rows come back as often as given;
    an empty table gives no rows; other columns of ``df`` are not read.
    """
    fps = saved(fingerprints(df, id_col, text_col, width), "fingerprints")
    named = _groups(fps, max_bits).select("fp", "component")
    return fps.join(named, "fp").select("id", "fp", "component")


def _groups(fps: DataFrame, max_bits: int) -> DataFrame:
    """(fp, first, root, component): every fingerprint with its smallest id, its group and the group's smallest id."""
    distinct = fps.groupBy("fp").agg(F.min("id").alias("first"))
    roots = connected_components(links(distinct, max_bits))
    named = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    named = saved(named, "fingerprint-roots")
    lowest = named.groupBy("root").agg(F.min("first").alias("component"))
    return named.join(lowest, "root").select("fp", "first", "root", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
             max_bits: int = 3) -> DataFrame:
    """``docs`` without all but one row of every near-duplicate group: that with the smallest id.

    Every group keeps exactly one row, whatever other groups' ids are: of
    repeated ids in a group one row stays, an id in several groups stays once in
    each, and a row with a null id stays only if no row of its group has an id.
    """
    rows = saved(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                             F.monotonically_increasing_id().alias("at")), "numbered")
    own = rows.select(F.struct(F.col("row")[id_col].alias("id"), "at").alias("own"), F.col("row")[text_col].alias("text"))
    fps = saved(fingerprints(own, "own", "text", width).select("id.id", "id.at", "fp"), "fingerprints")
    groups = _groups(fps, max_bits)
    # the survivor is the first row with the smallest id, and of its fingerprints the smallest
    chosen = groups.where(F.col("first").eqNullSafe(F.col("component"))).groupBy("root", "component").agg(
        F.min("fp").alias("_fp"))
    firsts = fps.groupBy("fp", "id").agg(F.min("at").alias("at"))
    keep = firsts.join(chosen, (F.col("fp") == F.col("_fp")) & F.col("id").eqNullSafe(F.col("component"))).select("at")
    return rows.join(keep, "at").select("row.*")
