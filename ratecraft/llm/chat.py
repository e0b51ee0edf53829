"""Chat formatting after cumulative-snapshot collapse, in DataFrame operations.

Logs often hold every state of a growing conversation.  A rolling hash of each
turn prefix finds conversations that another one continues; an anti-join keeps
the maximal ones, and only those are rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.operators.windows import running_stats

from .common import numbered, saved

CHUNK_TURNS = 256  # turns per block: the largest group a task holds
HASHES = ("h1", "h2")  # two 64-bit hashes, so that chance collisions stay out of reach at any size


def _render(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def _prefixes(turns: DataFrame) -> DataFrame:
    """Rows with ``pos`` (1-based place in the conversation) and rolling hashes of the prefix up to it.

    Places are running counts over range-partitioned rows; equal rows are
    numbered first.  The hash of a prefix is the XOR of hashes of (place, role,
    text), summed inside blocks of 256 places and then over the blocks before,
    so neither a long conversation nor one of equal turns is ever one group.
    """
    order = ["turn", "role", "text", "copy"]
    placed = running_stats(numbered(turns), ["conv_id"], order, count_col="pos").drop("copy")
    block = F.floor((F.col("pos") - 1) / CHUNK_TURNS).alias("block")
    hashed = saved(placed.select("conv_id", "chunk", block, "pos", "role", "text",
                                 F.xxhash64(F.lit(1), "pos", "role", "text").alias("t1"),
                                 F.xxhash64(F.lit(2), "role", "text", "pos").alias("t2")), "turns")
    key = ["conv_id", "block"]
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = hashed.groupBy(*key).agg(F.bit_xor("t1").alias("s1"), F.bit_xor("t2").alias("s2")).select(
        *key, *[F.coalesce(F.bit_xor(s).over(before), F.lit(0)).alias(f"{s}_before") for s in ("s1", "s2")])
    running = Window.partitionBy(*key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return hashed.withColumns({"r1": F.bit_xor("t1").over(running), "r2": F.bit_xor("t2").over(running)}).join(
        totals, key).select("conv_id", "chunk", "pos", "role", "text",
                            F.col("r1").bitwiseXOR(F.col("s1_before")).alias("h1"),
                            F.col("r2").bitwiseXOR(F.col("s2_before")).alias("h2"))


def collapse(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies): the maximal conversations.

    ``turns`` is the output of ``_prefixes``.  A conversation goes if its whole
    sequence of (role, text) is a proper prefix of another's; of equal ones the
    smallest id stays and ``copies`` says how many there were.
    """
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("n_turns"))
    marked = turns.select("conv_id", "pos", *HASHES).join(sizes, "conv_id")
    whole = (marked.where("pos = n_turns").groupBy("n_turns", *HASHES)
             .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies")))
    inner = marked.where("pos < n_turns").select(F.col("pos").alias("n_turns"), *HASHES).distinct()
    return whole.join(inner, ["n_turns", *HASHES], "left_anti").select("conv_id", "n_turns", "copies")


def format_conversations(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """(conv_id, segment, n_turns, copies, rendered) of the maximal conversations of ``df``.

    ``rendered`` holds the turns in ChatML.  A segment holds the turns of 256
    turn numbers, and 256 turns at most where numbers are null or repeat, so
    nearly every conversation is segment 0 alone, and the segments of a longer
    one follow each other.  Turns go by number, nulls first, then role and text;
    all rows of a repeated number are kept.  A null role is "user", a
    null text empty; "<|" in a text becomes "< |", so a text cannot end its own
    turn.  Rows with a null conversation id belong to no conversation and are
    left out.  Empty tables give no rows, other columns are not read.
    """
    turns = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("user")).alias("role"),
        F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("<|"), F.lit("< |")).alias("text")).withColumn(
        "chunk", F.coalesce(F.floor(F.col("turn") / CHUNK_TURNS), F.lit(-1)))
    placed = saved(_prefixes(turns), "prefixes")
    kept = collapse(placed)
    first = placed.groupBy("conv_id", "chunk").agg(F.min("pos").alias("first"))
    cut = F.floor((F.col("pos") - F.col("first")) / CHUNK_TURNS).alias("cut")
    parts = F.array_sort(F.collect_list(F.struct("pos", _render(F.col("role"), F.col("text")).alias("part"))))
    maximal = placed.join(kept, "conv_id").join(first, ["conv_id", "chunk"])
    segments = maximal.groupBy("conv_id", "chunk", cut, "n_turns", "copies").agg(
        F.min("pos").alias("at"), F.array_join(F.transform(parts, lambda x: x["part"]), "").alias("rendered"))
    numbered = Window.partitionBy("conv_id").orderBy("at")  # one row per chunk
    return segments.select("conv_id", (F.row_number().over(numbered) - 1).alias("segment"), "n_turns", "copies",
                           "rendered")
