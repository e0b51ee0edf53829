"""Flat-file readers and writers.

Schemas are always declared, never inferred: inference costs a full extra
pass over the input and guesses types (zip codes with leading zeros become
numbers).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecraft.functions.columns import one_hot_to_array

# The columns of the published files, in their order.
RATINGS_SCHEMA = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("item_id", T.IntegerType()),
    T.StructField("rating", T.FloatType()),
    T.StructField("timestamp", T.IntegerType()),
])

USERS_SCHEMA = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("occupation", T.StringType()),
    T.StructField("zipcode", T.StringType()),
])

LOOKUP_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("idx", T.IntegerType()),
])

TOTALS_SCHEMA = "n long, what string"


def items_schema(genres: Sequence[str]) -> T.StructType:
    fields = [T.StructField("item_id", T.IntegerType()), T.StructField("title", T.StringType()),
              T.StructField("release_date", T.StringType()),
              T.StructField("video_release_date", T.StringType()),
              T.StructField("url", T.StringType())]
    fields += [T.StructField(g, T.ByteType()) for g in genres]
    return T.StructType(fields)


# S1 / S5 ---------------------------------------------------------------------------
def read_ratings(spark: SparkSession, paths: str | Sequence[str], sep: str = "\t",
                 schema: T.StructType = RATINGS_SCHEMA) -> DataFrame:
    """Tab-separated ratings, no header; several paths read as one table."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.schema(schema).option("sep", sep).option("header", "false").csv(paths)


# S2 --------------------------------------------------------------------------------
def read_items(spark: SparkSession, path: str, genres: Sequence[str], sep: str = "|",
               encoding: str = "ISO-8859-1", fold_genres: bool = True) -> DataFrame:
    """Item file: id, title, dates, url, then one 0/1 flag per genre name.
    With ``fold_genres`` the flags become ``genres array<string>`` (P1)."""
    df = (spark.read.schema(items_schema(genres)).option("sep", sep)
          .option("encoding", encoding).option("header", "false").csv(path))
    if not fold_genres:
        return df
    return df.select("item_id", "title", "release_date", "video_release_date", "url",
                     one_hot_to_array(list(genres), list(genres)).alias("genres"))


# S3 --------------------------------------------------------------------------------
def read_users(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    return spark.read.schema(USERS_SCHEMA).option("sep", sep).option("header", "false").csv(path)


# S4 --------------------------------------------------------------------------------
def read_lookup(spark: SparkSession, path: str, sep: str = "|", with_index: bool = True) -> DataFrame:
    """``name|idx`` lists (or one name per line); blank lines are dropped."""
    if with_index:
        df = spark.read.schema(LOOKUP_SCHEMA).option("sep", sep).csv(path)
    else:
        df = spark.read.schema("name string").csv(path)
    return df.filter(F.col("name").isNotNull() & (F.trim("name") != ""))


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``<n> <what>`` (dataset control totals)."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parts = F.split(F.trim("value"), r"\s+", 2)
    return lines.select(parts[0].try_cast("long").alias("n"), parts[1].alias("what"))


# writers ----------------------------------------------------------------------------
def write_delimited(df: DataFrame, path: str, sep: str, encoding: str = "UTF-8", by: Sequence[str] = ()) -> str:
    """One folder of delimited files, or with ``by`` one per value of those columns, in a single job."""
    (df.write.partitionBy(*by).mode("overwrite").option("sep", sep).option("header", "false")
     .option("encoding", encoding).option("nullValue", "").csv(path))
    return path


# K7 ---------------------------------------------------------------------------------
def to_json_lines(df: DataFrame, col: str = "record") -> DataFrame:
    """One JSON text per row (real JSON, not a Python repr: decision Q5)."""
    return df.select(F.to_json(F.col(col)).alias("json"))


def write_json(df: DataFrame, path: str, compression: str = "none") -> str:
    """JSON lines; ``compression`` as Spark names it, which readers tell from the file names."""
    df.write.mode("overwrite").json(path, compression=compression)
    return path
