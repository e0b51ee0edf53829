"""Column functions, with the decisions of SURVEY §2.14 as cases."""

import datetime as dt

from pyspark.sql import functions as F

from ratecraft.functions import columns as C
from ratecraft.functions.udfs import capitalize_words_udf

NAMES = {"mira vell": "Mira Vell ", "two  gaps": "Two  Gaps ", "": " ", "o'Tool inner": "O'Tool Inner ",
         " lead": " Lead ", "trail ": "Trail  ", "éa ñu": "Éa Ñu ", None: None}


def test_capitalize_words_native_and_udf(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(NAMES)], "i int, name string")
    got = df.select("i", C.capitalize_words("name").alias("a"),
                    capitalize_words_udf("name").alias("b")).orderBy("i").collect()
    assert [r.a for r in got] == [r.b for r in got] == list(NAMES.values())  # not initcap: rest of a word kept


def test_composite_key_is_null_when_a_part_is_null(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (1, None)], "u long, m long")
    assert [r.k for r in df.select(C.composite_key("u", "m").alias("k")).collect()] == ["1_2", None, None]


def test_epoch_units(spark):
    df = spark.createDataFrame([("1000000000",)], "t string")
    r = df.select(C.epoch_to_date("t").alias("s"), C.epoch_to_date("t", "millis").alias("ms")).first()
    assert r.s == dt.date(2001, 9, 9)
    assert r.ms == dt.date(1970, 1, 12)  # the mapping's millisecond reading (Q2)


def test_multi_format_timestamp(spark):
    df = spark.createDataFrame([("2020-01-02 03:04:05",), ("2020-01-02",), ("1577934245000",),
                                ("garbage",), (None,)], "t string")
    got = [r.p for r in df.select(C.parse_multi_format_ts("t").cast("timestamp_ntz").alias("p")).collect()]
    assert got[0] == dt.datetime(2020, 1, 2, 3, 4, 5)
    assert got[1] == dt.datetime(2020, 1, 2)
    assert got[2] == dt.datetime(2020, 1, 2, 3, 4, 5)
    assert got[3] is None and got[4] is None


def test_incremental_mean_and_bad_rating(spark):
    df = spark.createDataFrame([(4.0, 3, "5"), (None, None, "2"), (4.0, 3, "bad")],
                               "m double, n long, x string")
    got = [r.v for r in df.select(C.incremental_mean("m", "n", "x").alias("v")).collect()]
    assert got[0] == (4.0 * 3 + 5) / 4 and got[1] == 2.0 and got[2] is None  # Q17: no ANSI error


def test_one_hot_keeps_declared_order(spark):
    df = spark.createDataFrame([(1, 0, 1), (0, 0, 0)], "a int, b int, c int")
    got = [r.g for r in df.select(C.one_hot_to_array(["c", "b", "a"], ["C", "B", "A"]).alias("g")).collect()]
    assert got == [["C", "A"], []]


def test_display_card(spark):
    df = spark.createDataFrame([(["Action", "Drama"], 4.0), ([], 3.456)], "g array<string>, a double")
    got = df.select(C.genre_text("g").alias("t"), C.two_decimals("a").alias("d"),
                    C.highlight("a").alias("h")).collect()
    assert (got[0].t, got[0].d, got[0].h) == ("Action, Drama", "4.00", True)
    assert (got[1].t, got[1].d, got[1].h) == ("", "3.46", False)
    edge = spark.createDataFrame([(1.0049999999999,), (1.005,), (2.675,), (0.125,), (-1.5,), (None,)], "a double")
    got = [r.d for r in edge.select(C.two_decimals("a").alias("d")).collect()]
    assert got == ["1.00", "1.00", "2.67", "0.13", "-1.50", None]  # by the binary value, exact halves up
