"""Driver tables and the rating-shaped views built on them.

The library works on any (user, item, rating, time) table.  The test data

* ``ratings_view``  lineitem ⋈ orders; user = o_custkey, item = l_partkey,
  rating = 1 + (quantity - 1) mod 5, ts = l_shipdate.  Rows are distinct
  over all lineitem columns, which therefore form the total order.
* ``events_view``   events; seq = event_id (unique), item = props.k.
* ``items_view``    part; title = p_name, genre flags from p_type / p_size.
* ``users_view``    customer; occupation = c_mktsegment.

Every view is a lazy projection over a Parquet scan, so column pruning and
filter pushdown reach the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# The genre flag names used for the part table stand-in,
# in declared order (six p_type values, then one size flag).
ITEM_GENRES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "BIG"]

# Columns that make a lineitem row unique; used as the order of ratings.
RATING_ORDER = ["ts", "l_orderkey", "l_linenumber", "item_id", "l_suppkey",
                "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                "l_returnflag", "l_linestatus"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rating_from_quantity(q: Column) -> Column:
    return (F.lit(1) + (q.cast("int") - F.lit(1)) % F.lit(5)).cast("double")


def ratings_view(spark: SparkSession, sf_dir: str, with_order: bool = False,
                 users: DataFrame | None = None) -> DataFrame:
    """(user_id, item_id, rating, ts) [+ lineitem tie-break columns] [+ columns of ``users``].

    ``users`` are joined on user_id (inner) to the orders, before the line items: a quarter of the rows
    to shuffle, with the same result as a join afterwards.
    """
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    known = [] if users is None else [c for c in users.columns if c != "user_id"]
    if users is not None:
        od = od.join(users.withColumnRenamed("user_id", "o_custkey"), "o_custkey")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    cols = [F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
            rating_from_quantity(F.col("l_quantity")).alias("rating"),
            F.col("l_shipdate").alias("ts")]
    if with_order:
        cols += [F.col(c) for c in RATING_ORDER if c not in ("ts", "item_id")]
    return j.select(*cols, *known)


def events_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq, user_id, item_id, rating, ts, event_type) from ``events``."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("seq"), "user_id",
        F.from_json("props", "k int").getField("k").cast("long").alias("item_id"),
        F.col("value").alias("rating"), "ts", "event_type")


def items_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as an item table with one 0/1 flag column per genre name."""
    p = table(spark, sf_dir, "part")
    flags = [F.when(F.col("p_type") == g, 1).otherwise(0).cast("byte").alias(g)
             for g in ITEM_GENRES[:-1]]
    flags.append(F.when(F.col("p_size") > 25, 1).otherwise(0).cast("byte").alias("BIG"))
    return p.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"),
                    F.col("p_brand").alias("brand"), *flags)


def users_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("user_id"),
                    F.col("c_nationkey").alias("age"),
                    F.substring("c_mktsegment", 1, 1).alias("gender"),
                    F.col("c_mktsegment").alias("occupation"),
                    F.col("c_name").alias("zipcode"))


# SQL twins of the views, for DuckDB oracles (same column names and values).
RATINGS_SQL = ("(SELECT o_custkey AS user_id, l_partkey AS item_id, "
               "CAST(1 + (CAST(l_quantity AS INTEGER) - 1) % 5 AS DOUBLE) AS rating, "
               "l_shipdate AS ts, l_orderkey, l_linenumber, l_suppkey, l_quantity, "
               "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus "
               "FROM lineitem JOIN orders ON l_orderkey = o_orderkey)")
EVENTS_SQL = ("(SELECT event_id AS seq, user_id, "
              "CAST(json_extract(props, '$.k') AS BIGINT) AS item_id, value AS rating, ts, "
              "event_type FROM events)")
ITEMS_SQL = ("(SELECT p_partkey AS item_id, p_name AS title, p_brand AS brand, "
             + ", ".join(f"CAST(CASE WHEN p_type = '{g}' THEN 1 ELSE 0 END AS TINYINT) AS \"{g}\""
                         for g in ITEM_GENRES[:-1])
             + ", CAST(CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS TINYINT) AS \"BIG\" FROM part)")
USERS_SQL = ("(SELECT c_custkey AS user_id, c_nationkey AS age, substr(c_mktsegment, 1, 1) AS gender, "
             "c_mktsegment AS occupation, c_name AS zipcode FROM customer)")
