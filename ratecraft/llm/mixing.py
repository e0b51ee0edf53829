"""Mixing sources to target weights by the cube method of balanced sampling.

A source's share of the mix and its size give each of its documents the same
expected number of copies; the whole copies are sure, the fraction is a
probability.  The flight phase moves the probabilities of three documents at a
time along a direction that keeps both the expected words and the expected
documents (the null space of the two constraints) until one of them is 0 or 1.
What no move is left for, a few documents a source, is the landing problem.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.operators.windows import row_index

from .common import numbered, saved

LARGEST, OTHERS = 4, 8  # documents of a source that never fly: they land together, all choices compared
LANDING = LARGEST + OTHERS


def flight(sizes: Sequence[int], probs: Sequence[float], rng: random.Random) -> list[float]:
    """Probabilities after the flight: 0 or 1 but for two at most, with the expected size and count of before.

    With both directions of a move open, each is taken with the probability that
    keeps every document's expectation.
    """
    p = list(probs)
    live: list[int] = []
    for i in range(len(p)):
        if not 0.0 < p[i] < 1.0:
            continue
        live.append(i)
        if len(live) < 3:
            continue
        a, b, c = live
        u = (sizes[b] - sizes[c], sizes[c] - sizes[a], sizes[a] - sizes[b])
        if not any(u):
            u = (1, -1, 0)  # equal sizes: exchange two of them
        ahead = behind = float("inf")
        for k, d in zip(live, u):
            if d:
                up, down = (1.0 - p[k]) / abs(d), p[k] / abs(d)
                ahead, behind = (min(ahead, up), min(behind, down)) if d > 0 else (min(ahead, down), min(behind, up))
        step = ahead if rng.random() * (ahead + behind) < behind else -behind
        for k, d in zip(live, u):
            x = p[k] + step * d
            p[k] = 0.0 if x < 1e-9 else 1.0 if x > 1 - 1e-9 else x
        live = [k for k in live if 0.0 < p[k] < 1.0]
    return p


def land(sizes: Sequence[int], probs: Sequence[float]) -> list[float]:
    """The choice of 0 or 1 for every document that misses the expected size and count least, all compared.

    A miss in size counts in middling sizes of the documents, so both totals weigh alike.
    """
    n = len(sizes)
    if not n:
        return []
    picks = (np.arange(1 << n)[:, None] >> np.arange(n) & 1).astype(np.float64)
    size, prob = np.asarray(sizes, dtype=np.float64), np.asarray(probs)
    miss = np.abs(picks @ size - size @ prob) / max(np.median(size), 1.0) + np.abs(picks.sum(axis=1) - prob.sum())
    return picks[int(np.argmin(np.round(miss, 9)))].tolist()


def source_targets(rows: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """(source, n, source_size, place, target) of (source, size) rows.

    Sources in code-point order, null last, weigh ``weights`` in turn and divide
    ``share`` of all sizes.  No target exceeds ``most`` times its source's size:
    with a common level L a target is min(most * size, weight * L), and L grows
    until the targets add up.  Only the level, two whole numbers, is on the
    driver; each round is an aggregate over the sources.
    """
    stats = rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").cast("decimal(38,0)").alias("source_size"))
    stats = stats.select("source", "n", "source_size", F.col("source").isNull().alias("last"))
    placed = row_index(stats, ["last", "source"], name="place")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    placed = saved(placed.select("source", "n", "source_size", "place", turn.cast("decimal(38,0)").alias("weight")),
                   "sources")
    top, bottom = (int(x) for x in share.as_integer_ratio())
    total = int(placed.agg(F.sum("source_size")).first()[0] or 0) * top  # in units of 1 / bottom
    level = (0, 1)
    while True:
        over = F.col("weight") * F.lit(str(level[0])).cast("decimal(38,0)") > (
            F.col("source_size") * F.lit(str(most * level[1])).cast("decimal(38,0)"))
        got = placed.agg(F.sum(F.when(over, F.col("source_size"))).alias("held"),
                         F.sum(F.when(~over, F.col("weight"))).alias("free")).first()
        if not got["free"]:
            break
        new = (total - bottom * most * int(got["held"] or 0), bottom * int(got["free"]))
        if new[0] * level[1] <= level[0] * new[1]:
            break
        level = new
    cap = F.col("source_size").cast("double") * most
    target = F.when(over, cap).otherwise(F.col("weight").cast("double") * level[0] / level[1])
    return placed.select("source", "n", F.col("source_size").cast("long"), "place", target.alias("target"))


def _decide(rows: DataFrame, block_rows: int, seed: int) -> DataFrame:
    """``rows`` with every ``prob`` at 0 or 1: blocks of a source fly, what they leave flies again, the last lands."""
    rows = rows.withColumn("blocks", F.ceil(F.col("n") / block_rows))
    fields = [c for c in rows.columns]

    def settle(level: int):
        def run(table: pa.Table) -> pa.Table:
            size, prob, mark = (table.column(c).to_numpy() for c in ("size", "prob", "mark"))
            free = np.flatnonzero((prob > 0) & (prob < 1))
            if len(free):
                free = free[np.lexsort((size[free], mark[free]))]
                large = np.argsort(-size[free], kind="stable")[:LARGEST]  # kept back: a flight would end with them
                free = np.concatenate([np.delete(free, large), free[large]])
                sizes, probs = size[free].tolist(), prob[free].tolist()
                cut = max(len(free) - LANDING, 0)
                place, block = table.column("place")[0].as_py(), table.column("block")[0].as_py()
                flown = flight(sizes[:cut], probs[:cut], random.Random(f"{seed} {level} {place} {block}")) + probs[cut:]
                if table.column("blocks")[0].as_py() == 1:
                    left = [i for i, p in enumerate(flown) if 0 < p < 1]
                    for i, p in zip(left, land([sizes[i] for i in left], [flown[i] for i in left])):
                        flown[i] = p
                prob = prob.copy()
                prob[free] = flown
            at = table.column_names.index("prob")
            return table.set_column(at, "prob", pa.array(prob)).select(fields)
        return run

    most = rows.agg(F.max("blocks")).first()[0] or 1
    done, level = [], 0
    while True:
        block = F.pmod(F.xxhash64(F.lit(level), "mark"), F.col("blocks"))
        flown = rows.withColumn("block", block).groupBy("place", "block").applyInArrow(settle(level), rows.schema)
        flown = saved(flown, "flight")
        if most == 1:
            break
        open_ = (F.col("prob") > 0) & (F.col("prob") < 1)
        done.append(flown.where(~open_))
        again = (LANDING + 2) * F.col("blocks")
        rows = flown.where(open_).withColumn("blocks", F.ceil(again / block_rows))
        most, level = -(-(LANDING + 2) * most // block_rows), level + 1
    for part in done:
        flown = flown.union(part)
    return flown


def mix(df: DataFrame, size: Column, source: Column, carry: Sequence[str], weights: Sequence[int] = (3, 1, 2),
        share: float = 1.5, most: int = 2, block_rows: int = 4_000, seed: int = 42) -> DataFrame:
    """One row per row of ``df``: the columns ``carry``, source, size, source_size, target, copies, taken.

    ``copies`` says how often the mix takes the row (0 to ``most``) and ``taken``
    is its size times that.  Every source's taken sizes come as near to its
    target as fourteen documents decided together can bring them, with nearly as
    many documents as expected.  A null or negative size counts
    as 0; a null source is a source of its own; sources without size take
    nothing.  Null and repeated ids and repeated rows are documents like any
    other.  An empty table gives no rows.

    Blocks of about ``block_rows`` rows of a source, by a hash of the row, fly by
    themselves, so a hot source is many tasks; the fourteen documents at most
    that each leaves behind fly again.  Equal rows are counted, then numbered, so they
    spread too.  All choices hang on hashes and ``seed`` alone: reruns agree, on
    any partitioning.
    """
    own = F.greatest(F.coalesce(size, F.lit(0)).cast("long"), F.lit(0))
    rows = df.select(F.struct(*[df[c] for c in carry]).alias("row"), source.cast("string").alias("source"),
                     own.alias("size"))
    mark = F.xxhash64(F.lit(seed), "row", "source", "size", "copy")
    rows = saved(numbered(rows).withColumn("mark", mark).drop("copy"), "mix")
    targets = saved(source_targets(rows, weights, share, most), "targets")
    of = targets.withColumnRenamed("source", "of")
    known = rows.join(of, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    ratio = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most))))
    known = known.withColumn("ratio", F.coalesce(ratio, F.lit(0.0)))
    known = known.withColumns({"sure": F.floor("ratio"), "prob": F.col("ratio") - F.floor("ratio")})
    return _decide(known, block_rows, seed).select(
        "row.*", "source", "size", "source_size", "target", (F.col("sure") + F.col("prob")).cast("int").alias("copies"),
        (F.col("size") * (F.col("sure") + F.col("prob")).cast("long")).alias("taken"))
