"""Connected components of a link table, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, saved_at


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of a link; root is the smallest node it reaches.

    Alternating large-star and small-star rounds: each one reconnects every
    node to the smallest neighbour, and the number of rounds is logarithmic in
    the size of a component.  A round is two joins on the node, which Spark
    splits where a node is hot; nothing but a count and a checksum of the round
    comes to the driver.  Links with a null end and links of a node to itself
    are left out, repeated links count once, no links give no rows.
    """
    edges, path = saved_at(links.where((F.col(a) != F.col(b)))
                           .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "links")
    before = None
    while True:
        mark = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == before or not mark[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select("b", "b").distinct())
        before = mark
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = joined.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            joined.select("a", "m"))
        old = path
        edges, path = saved_at(small.distinct(), "links")
        discard(links.sparkSession, old)  # a round reads the one before only
