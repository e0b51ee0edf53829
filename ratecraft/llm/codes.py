"""Vector code compression: each vector becomes a few codebook indexes.

Vectors are cut into parts; every part position has a codebook learned by
rounds of nearest-entry assignment and averaging, all in whole numbers.  The
nearest entry is found by slices: the entries' coordinates are sorted per
dimension, and a prefix mask says which entries lie at or below each place.
The entries within a radius of a coordinate are one mask without another; the
AND over all dimensions leaves the entries of a box, and only those are
measured.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved
from .shards import finite_vector

LARGEST = 1 << 26  # of a whole-number component: squared distances stay within 64 bits


class SliceIndex:
    """Exact nearest entries of one codebook (entries x dimensions, whole numbers)."""

    def __init__(self, entries: np.ndarray):
        self.entries, self.columns = entries, np.ascontiguousarray(entries.T)
        n, dims = entries.shape
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(entries, order, axis=0).T)
        words = -(-n // 64)
        self.prefix = np.zeros((dims, n + 1, words), dtype=np.uint64)  # [d, k]: the first k entries of dimension d
        for d in range(dims):
            bits = np.zeros((n, words), dtype=np.uint64)
            bits[np.arange(n), order[:, d] >> 6] = np.uint64(1) << (order[:, d] & 63).astype(np.uint64)
            self.prefix[d, 1:] = np.bitwise_or.accumulate(bits, axis=0)
        self.radius = self._spacing()

    def _spacing(self) -> int:
        """A first radius: the usual distance from an entry to the next one."""
        gaps = [d[d > 0].min() for d in (((self.entries - e) ** 2).sum(axis=1) for e in self.entries) if d.any()]
        return int(np.sqrt(np.median(gaps))) + 1 if gaps else 1

    def box(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Mask of the entries with every coordinate within the point's radius."""
        masks = None
        for d, (line, prefix) in enumerate(zip(self.sorted, self.prefix)):
            x = points[:, d]
            inside = (prefix[np.searchsorted(line, x + radius, "right")]
                      & ~prefix[np.searchsorted(line, x - radius, "left")])
            masks = inside if masks is None else masks & inside
        if masks is None:  # no dimensions: every entry is at distance 0
            masks = np.zeros((len(points), self.prefix.shape[2]), dtype=np.uint64)
            masks[:, 0] = 1
        return masks

    def nearest(self, points: np.ndarray, radius: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
        """(entry, squared distance) of every point, ties to the lower entry, and the entries measured.

        A box that holds an entry no farther than its radius holds the nearest
        one and all its ties.  Otherwise the radius grows to the best distance
        found, which the next box settles, or doubles where the box was empty.
        """
        best = np.full(len(points), -1, dtype=np.int64)
        error = np.zeros(len(points), dtype=np.int64)
        todo = np.arange(len(points))
        reach = np.full(len(points), radius or self.radius, dtype=np.int64)
        measured = 0
        while len(todo):
            at, entry, dist = self._measure(points[todo], self.box(points[todo], reach[todo]), reach[todo])
            measured += len(at)
            if len(at):
                first = np.flatnonzero(np.concatenate([[True], np.diff(at) != 0]))
                least = np.minimum.reduceat(dist, first)
                owner, size = at[first], np.diff(np.concatenate([first, [len(at)]]))
                hit = np.flatnonzero(dist == np.repeat(least, size))  # entries ascend inside a point
                lowest = hit[np.concatenate([[True], np.diff(at[hit]) != 0])]
                best[todo[owner]], error[todo[owner]] = entry[lowest], least
            found = best[todo] >= 0
            root = np.sqrt(error[todo].astype(np.float64)).astype(np.int64) + 1
            done = found & (error[todo] <= reach[todo] ** 2)
            reach[todo] = np.where(found, root, reach[todo] * 2)
            todo = todo[~done]
        return best, error, measured

    def _measure(self, points, masks, reach):
        """(point, entry, squared distance) of the entries in the boxes, by point and entry.

        Dimensions are added a few at a time; of the entries that leave the ball of
        the radius on the way only one a point is kept, to set the next radius.
        """
        bits = np.unpackbits(masks.view(np.uint8).reshape(len(points), -1), axis=1, bitorder="little")
        at, entry = np.nonzero(bits)
        dist = np.zeros(len(at), dtype=np.int64)
        points, limit = np.ascontiguousarray(points.T), reach ** 2
        for d in range(len(points)):
            gap = points[d].take(at)
            gap -= self.columns[d].take(entry)
            gap *= gap
            dist += gap
            if d % 4 == 3 and d + 1 < len(points):
                keep = dist <= limit.take(at)
                some = np.zeros(len(limit), dtype=bool)
                some[at[keep]] = True
                keep |= ~some.take(at) & np.concatenate([[True], np.diff(at) != 0])
                keep = np.flatnonzero(keep)
                at, entry, dist = at.take(keep), entry.take(keep), dist.take(keep)
        return at, entry, dist


def _parts(column: pa.Array, width: int, parts: int) -> np.ndarray:
    """Rows x parts x dimensions of a list column, padded with zeros to ``width``."""
    lens = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lens == width).all():
        return flat.reshape(len(lens), parts, width // parts)
    out = np.zeros((len(lens), width), dtype=np.int64)
    row = np.repeat(np.arange(len(lens)), lens)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)] = flat
    return out.reshape(len(lens), parts, width // parts)


def _blocks(column: pa.Array, width: int, parts: int, rows: int = 2048):
    for lo in range(0, len(column), rows):
        yield lo, _parts(column.slice(lo, rows), width, parts)


def _new_books(vecs: DataFrame, books: list[np.ndarray], radius: list[int], width: int):
    """One round: (codebooks after averaging, mean distance per part).

    A task adds up its own rows per entry; what is shuffled and returned is one
    row per task and entry, then one row per entry.
    """
    parts, dims = len(books), books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = [SliceIndex(b) for b in books]
        total = [np.zeros((len(b), dims + 2), dtype=np.int64) for b in books]  # sums, rows, roots of the errors
        for batch in batches:
            for _, block in _blocks(batch.column(0), width, parts):
                for p in range(parts):
                    entry, error, _ = index[p].nearest(block[:, p], radius[p])
                    own = np.column_stack([block[:, p], np.ones(len(block), dtype=np.int64),
                                           np.sqrt(error).astype(np.int64)])
                    np.add.at(total[p], entry, own)
        for p, t in enumerate(total):
            used = np.flatnonzero(t[:, dims])
            if len(used):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p] * len(used), pa.int32()), pa.array(used, pa.int32()),
                     pa.array(t[used].tolist(), pa.list_(pa.int64()))], names=["part", "entry", "sums"])

    sums = vecs.select("q").mapInArrow(run, "part int, entry int, sums array<long>")
    each = sums.select("part", "entry", F.posexplode("sums").alias("pos", "s"))
    got = each.groupBy("part", "entry", "pos").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    found: dict[tuple[int, int], dict[int, int]] = {}
    for r in got:  # parts x entries x dimensions rows, whatever the table
        found.setdefault((r["part"], r["entry"]), {})[r["pos"]] = int(r["s"])
    after, reach = [b.copy() for b in books], [1] * parts
    rows, roots = [0] * parts, [0] * parts
    for (p, e), s in found.items():
        after[p][e] = [s[d] // s[dims] for d in range(dims)]
        rows[p] += s[dims]
        roots[p] += s[dims + 1]
    for p in range(parts):
        reach[p] = roots[p] // max(rows[p], 1) + 1
    return after, reach


def compress(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
             parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> tuple[DataFrame, list]:
    """(rows, codebooks): id, label, codes array<int> (one index per part), error long; codebooks as arrays.

    Rows whose vector is null or holds null or non-finite components are left
    out; so are no others.  A component x counts as floor(``scale`` * x), which
    must stay below 2^26 in size (a larger one stops the job with an error).
    Vectors shorter than the longest, or of a length that ``parts`` does not
    divide, count as padded with zeros.  The codebooks start as the parts of the
    ``entries`` smallest ids (null ids last, equal ids by components), or of all
    rows where there are fewer.  A round assigns every part to its nearest entry
    (ties to the lower index) and sets each used entry to the floor of its
    parts' mean.  Null and repeated ids and repeated rows each count and come
    back; a null label is kept; an empty table gives no rows and no codebooks.

    Only the codebooks pass through the driver: ``entries`` vectors, whatever the
    table.  Rows stay where they were read; no row is shuffled.
    """
    fits = F.forall("q", lambda x: F.abs(x) < LARGEST)
    vecs = (df.where(finite_vector(F.col(vec_col)) | (F.size(vec_col) == 0))
            .select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("v"))
            .select("id", "label", F.transform("v", lambda x: F.floor(x.cast("double") * scale)).alias("q"))
            .select("id", "label", F.when(fits, F.col("q")).otherwise(
                F.raise_error(F.lit(f"a component is not below 2^26 / {scale}")).cast("array<long>")).alias("q")))
    vecs = saved(vecs, "vectors")
    longest = vecs.agg(F.max(F.size("q"))).first()[0]
    if longest is None:
        return vecs.select("id", "label", F.array().cast("array<int>").alias("codes"),
                           F.lit(0).cast("long").alias("error")), []
    width = -(-longest // parts) * parts
    first = vecs.orderBy(F.col("id").asc_nulls_last(), "q").limit(entries).select("q").collect()
    start = _parts(pa.array([r["q"] for r in first], pa.list_(pa.int64())), width, parts)
    books = [np.ascontiguousarray(start[:, p]) for p in range(parts)]
    reach: list = [None] * parts
    for _ in range(rounds):
        books, reach = _new_books(vecs, books, reach, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = [SliceIndex(b) for b in books]
        for batch in batches:
            for lo, block in _blocks(batch.column(2), width, parts):
                found = [index[p].nearest(block[:, p], reach[p]) for p in range(parts)]
                codes = np.column_stack([f[0] for f in found]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(block)), batch.column(1).slice(lo, len(block)),
                     pa.ListArray.from_arrays(np.arange(len(block) + 1, dtype=np.int32) * parts,
                                              pa.array(codes.ravel())),
                     pa.array(sum(f[1] for f in found))], names=["id", "label", "codes", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in vecs.schema}
    coded = vecs.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, codes array<int>, error long")
    return saved(coded, "codes"), books


def digest(books: list) -> str:
    """sha256 of all entries' components by part, entry and position, joined with commas."""
    text = ",".join(str(x) for b in books for x in np.asarray(b).ravel().tolist())
    return hashlib.sha256(text.encode()).hexdigest()
