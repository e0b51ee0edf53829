"""Pages of a total order read through a sparse index.

The rows are laid down once, sorted, a file per range of the order.  The index
keeps one fence a file: its first key, its rows and the rows before it.  A page
then reads the fences, opens the file or two that hold it, and of those only the
row groups and column pages with its places, which Parquet statistics find.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ratecraft.operators.windows import in_order
from ratecraft.session import work_dir

GROUP_BYTES = 8 << 20  # of a row group: readers of a range of places skip the other groups by their statistics


class PageIndex:
    """A table in a total order, under one folder: ``rows`` by part, ``fences`` one row a part."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.fences = spark.read.parquet(f"{self.path}/fences")
        declared = spark.read.text(f"{self.path}/schema").first()[0]  # an empty table has no files to tell it
        self.rows = spark.read.schema(StructType.fromJson(json.loads(declared))).parquet(f"{self.path}/rows")
        self.order = self.fences.schema["first"].dataType.names

    @classmethod
    def build(cls, df: DataFrame, order: Sequence[str], path: str | None = None,
              parts: int | None = None, columns: Sequence[Column] | None = None) -> PageIndex:
        """Lay ``df`` down in ``order`` (nulls first) under ``path``, a work folder unless given.

        ``columns`` to keep besides the order (default: all) are made after the shuffle, of plain columns.

        ``parts`` files, or as many as the session's shuffle partitions hold the
        rows in.  Any number of pages can be read afterwards, also by another
        session with ``PageIndex(spark, path)``.
        """
        spark = df.sparkSession
        path = (path or work_dir(spark, "pages")).rstrip("/")
        placed = in_order(df, order, parts)
        if columns is not None:
            placed = placed.select(*order, *columns, "_part", "_at")
        placed.write.partitionBy("_part").option("parquet.block.size", str(GROUP_BYTES)).parquet(f"{path}/rows")
        spark.createDataFrame([(placed.schema.json(),)], "schema string").coalesce(1).write.text(f"{path}/schema")
        laid = spark.read.schema(placed.schema).parquet(f"{path}/rows")
        sizes = laid.groupBy("_part").agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("first"))
        before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
        start = F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
        sizes.select("_part", "first", "n", start).coalesce(1).write.parquet(f"{path}/fences")
        return cls(spark, path)

    def total(self) -> int:
        """Rows in all, from the fences."""
        return self.fences.agg(F.sum("n")).first()[0] or 0

    def slice(self, lo: int, hi: int, position: str = "position") -> DataFrame:
        """The rows at 0-based places ``lo`` to ``hi`` (not included), with their place.

        Only fences come to the driver, those of the files that the slice touches.
        """
        held = self.fences.where((F.col("start") < hi) & (F.col("start") + F.col("n") > lo)).select(
            "_part", "start").collect()
        if not held:
            return self.rows.withColumn(position, F.lit(0).cast("long")).drop("_part", "_at").limit(0)
        here = [(F.col("_part") == r["_part"]) & (F.col("_at") >= lo - r["start"]) & (F.col("_at") < hi - r["start"])
                for r in held]
        place = F.coalesce(*[F.when(F.col("_part") == r["_part"], F.col("_at") + r["start"]) for r in held])
        return self.rows.where(reduce(Column.__or__, here)).withColumn(position, place).drop("_part", "_at")

    def page(self, page: int, per_page: int = 10, position: str = "position") -> DataFrame:
        """Page ``page`` (from 1), every row with its place in the whole; page 0 or one past the end is empty."""
        if per_page < 1:
            raise ValueError("per_page must be >= 1")
        lo = (page - 1) * per_page
        return self.slice(lo, lo + per_page if page > 0 else lo, position)

    def place_of(self, *key) -> int:
        """How many rows come before ``key`` (values of the order's first columns): one file is read."""
        names = self.order[:len(key)]
        held = self.fences.where(F.struct(*[F.col(f"first.{c}").alias(c) for c in names])
                                 < F.struct(*[F.lit(v).alias(c) for c, v in zip(names, key)]))
        last = held.orderBy(F.col("_part").desc()).select("_part", "start").first()
        if last is None:
            return 0
        inside = self.rows.where((F.col("_part") == last["_part"]) & (
            F.struct(*names) < F.struct(*[F.lit(v).alias(c) for c, v in zip(names, key)])))
        return last["start"] + inside.count()
