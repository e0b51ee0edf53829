"""Conflict-constrained best-fit packing.

Pieces go, longest first, into the open bin with the least room that still
takes them and holds neither their source nor their duplicate cluster.  Bins
are ordered by residual room and carry bitmaps of both; the search for a bin
walks on from the tightest until one is compatible.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered

HOT_SHARE = 64  # a class with more than 1/64 of a shard's pieces gets an ordered list of its own


def best_fit(sizes: list[int], classes: list[tuple], capacity: int) -> tuple[list[int], list[int]]:
    """(bin, offset in the bin) of every piece, in the order given.

    ``classes`` names what may be only once in a bin: two pieces that share one
    never share a bin.  A class held by a large part of the pieces would make
    the search walk over all bins that hold it; for such classes the bins
    without it are kept in a residual-ordered list of their own.  All lists
    give the same answer: the compatible bin with the least room, the oldest of
    several.
    """
    uses = Counter(c for own in classes for c in set(own))
    bit = {c: 1 << i for i, c in enumerate(c for c, n in uses.items() if n > 1)}
    hot = [c for c, n in uses.most_common(128) if n > 1 and n * HOT_SHARE > len(sizes)]
    everything: list[tuple[int, int]] = []  # (room, bin), open bins by residual
    without = {c: [] for c in hot}
    used: list[int] = []  # per bin: bitmap of its sources and clusters
    room: list[int] = []
    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    for size, own, i in sorted(zip(sizes, classes, range(len(sizes))), key=lambda x: (-x[0], x[2])):
        mask = 0
        for c in own:
            mask |= bit.get(c, 0)
        listed = max((c for c in own if c in without), key=uses.__getitem__, default=None)
        order = everything if listed is None else without[listed]
        at = bisect_left(order, (size, -1))
        while at < len(order) and used[order[at][1]] & mask:
            at += 1
        if at < len(order):
            left, b = order[at]
            for c, other in (*without.items(), (None, everything)):
                if c is None or not used[b] & bit[c]:
                    del other[bisect_left(other, (left, b))]
        else:
            left, b = capacity, len(used)
            used.append(0)
            room.append(capacity)
        bins[i], offsets[i] = b, capacity - left
        used[b] |= mask
        room[b] = left - size
        if room[b] > 0:
            insort(everything, (room[b], b))
            for c, other in without.items():
                if not used[b] & bit[c]:
                    insort(other, (room[b], b))
    return bins, offsets


def pack(df: DataFrame, size: Column, capacity: int, source: Column, cluster: Column, id_col: str = "doc_id",
         shard_rows: int = 20_000) -> DataFrame:
    """(id, piece, shard, bin, bin_offset, size) for every document of ``df``.

    A document over ``capacity`` is cut into pieces: all but the last fill a bin
    each, the last is packed like any other.  Documents are spread over shards
    of about ``shard_rows`` by a hash of their id and cluster and, of equal rows,
    their number, never by source or cluster alone, and each shard is packed by
    itself: memory is bounded, and a hot source, cluster or null id meets itself
    in every shard alike.  Every
    document comes back: sizes null or below 1 take no room and go to bin -1.  A
    null source or cluster conflicts with nothing.  Repeated rows share a
    cluster, so never a bin; pieces of one document neither.  Ties in size go by
    id, then cluster.  An empty table gives no rows; extra columns are not read.
    """
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(size, F.lit(0)).cast("long").alias("size"),
                     source.cast("string").alias("source"), cluster.cast("string").alias("cluster"))
    shards = max(1, -(-rows.count() // shard_rows))
    spread = F.xxhash64("id", "cluster", "copy", F.lit("pack"))
    rows = numbered(rows).withColumn("shard", F.pmod(spread, F.lit(shards)).cast("int")).drop("copy")
    kind = rows.schema["id"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        doc, size, source, cluster, shard = (table.column(c).to_pylist() for c in
                                             ("id", "size", "source", "cluster", "shard"))
        order = sorted(range(len(doc)), key=lambda i: (-size[i], doc[i] is None, 0 if doc[i] is None else doc[i], cluster[i] or ""))
        out: list[tuple] = []
        todo: list[tuple] = []
        b = 0
        for i in order:
            if size[i] < 1:
                out.append((doc[i], 0, -1, 0, size[i]))
                continue
            whole, rest = divmod(size[i], capacity)
            for piece in range(whole):
                out.append((doc[i], piece, b, 0, capacity))
                b += 1
            if rest:
                own = tuple((k, v) for k, v in (("source", source[i]), ("cluster", cluster[i])) if v is not None)
                todo.append((doc[i], whole, rest, own))
        bins, offsets = best_fit([t[2] for t in todo], [t[3] for t in todo], capacity)
        out += [(t[0], t[1], b + k, at, t[2]) for t, k, at in zip(todo, bins, offsets)]
        got = list(zip(*out))
        return pa.table([pa.array(got[0], table.schema.field("id").type), pa.array(got[1], pa.int32()),
                         pa.array([shard[0]] * len(out), pa.int32()), pa.array(got[2], pa.int32()),
                         pa.array(got[3], pa.int64()), pa.array(got[4], pa.int64())],
                        names=["id", "piece", "shard", "bin", "bin_offset", "size"])

    return rows.groupBy("shard").applyInArrow(
        run, f"id {kind}, piece int, shard int, bin int, bin_offset long, size long")
