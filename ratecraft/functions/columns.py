"""Column-level functions.

Every function returns a ``Column`` built from built-in expressions, so it
stays inside whole-stage code generation; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# P1 ---------------------------------------------------------------------------
def one_hot_to_array(flag_cols: Sequence[ColumnOrName], names: Sequence[str]) -> Column:
    """Names whose flag equals 1, in the declared order of ``names``."""
    if len(flag_cols) != len(names):
        raise ValueError("flag_cols and names must have the same length")
    picked = [F.when(_c(c) == 1, F.lit(n)) for c, n in zip(flag_cols, names)]
    return F.filter(F.array(*picked), lambda x: x.isNotNull())


# P2 ---------------------------------------------------------------------------
def nest_record(user: dict[str, ColumnOrName], movie: dict[str, ColumnOrName],
                rating: ColumnOrName, timestamp: ColumnOrName) -> Column:
    """Flat row -> {user{..}, movie{..}, rating, timestamp}; scalar leaves as strings.

    Arrays (e.g. genres) are kept as arrays of strings.
    """
    def leaf(c: ColumnOrName) -> Column:
        return _c(c).cast("string")

    def group(fields: dict[str, ColumnOrName]) -> Column:
        out = []
        for name, c in fields.items():
            col = _c(c)
            out.append((col if name == "genres" else leaf(col)).alias(name))
        return F.struct(*out)

    return F.struct(group(user).alias("user"), group(movie).alias("movie"),
                    leaf(rating).alias("rating"), leaf(timestamp).alias("timestamp"))


# P3 / P4 ----------------------------------------------------------------------
def to_payload(df: DataFrame, col: str = "record") -> DataFrame:
    """Struct column -> message ``value`` bytes holding real JSON."""
    return df.select(F.to_json(F.col(col)).cast("binary").alias("value"))


def payload_text(c: ColumnOrName) -> Column:
    """Binary message payload -> UTF-8 text."""
    return _c(c).cast("string")


def parse_json(c: ColumnOrName, schema: T.StructType | str) -> Column:
    """Permissive JSON parse against a declared schema; bad text -> null fields."""
    return F.from_json(_c(c), schema, {"mode": "PERMISSIVE"})


def json_of_literals(c: ColumnOrName) -> Column:
    r"""JSON text of a record printed as a literal: quotes '..' or "..", None, True, False, escapes \' and \xNN.

    Strings are told from the rest first, so words and quotes inside them stay as they are.
    """
    mark = "\u0001"
    strings = F.regexp_replace(_c(c), r"""'((?:[^'\\]|\\.)*)'|"((?:[^"\\]|\\.)*)["]""", f"{mark}$1$2{mark}")

    def outside(x: Column) -> Column:
        for word, json in (("None", "null"), ("True", "true"), ("False", "false")):
            x = F.regexp_replace(x, rf"\b{word}\b", json)
        return x

    def inside(x: Column) -> Column:
        x = F.regexp_replace(F.replace(x, F.lit("\\'"), F.lit("'")), r"\\x([0-9a-fA-F]{2})", r"\\u00$1")
        return F.regexp_replace(x, r'(?<!\\)((?:\\\\)*)"', r'$1\\"')

    pieces = F.transform(F.split(strings, mark), lambda x, i: F.when(i % 2 == 0, outside(x)).otherwise(inside(x)))
    return F.array_join(pieces, '"')


def salvage_json(c: ColumnOrName, schema: T.StructType) -> Column:
    """``schema`` read field by field: a field of the wrong type is null, and no other field is touched by it.

    Text that is no JSON is tried once more as a printed literal; what cannot be
    read either way is a null struct.
    """
    return variant_fields(salvage_variant(c), schema)


def salvage_variant(c: ColumnOrName) -> Column:
    """Text as a variant: JSON, or else a printed literal; null if it is neither."""
    return F.coalesce(F.try_parse_json(_c(c)), F.try_parse_json(json_of_literals(c)))


def variant_fields(c: ColumnOrName, schema: T.StructType) -> Column:
    """``schema`` read field by field from a variant; a null variant is a null struct.  Select the variant as a
    column of its own before: an expression given here is evaluated once a field."""
    parsed = _c(c)

    def field(path: str, kind: T.DataType) -> Column:
        if isinstance(kind, T.StructType):
            return F.struct(*[field(f"{path}.{f.name}", f.dataType).alias(f.name) for f in kind.fields])
        return F.try_variant_get(parsed, path, kind.simpleString())

    return F.when(parsed.isNotNull(), field("$", schema))


# P7 ---------------------------------------------------------------------------
def composite_key(*parts: ColumnOrName, sep: str = "_") -> Column:
    """``a_b`` key; null if any part is null (decision Q5, unlike concat_ws)."""
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(_c(p).cast("string"))
    return F.concat(*pieces)


# P8 ---------------------------------------------------------------------------
def epoch_to_date(c: ColumnOrName, unit: str = "seconds") -> Column:
    return F.to_date(epoch_to_timestamp(c, unit))


def epoch_to_timestamp(c: ColumnOrName, unit: str = "seconds") -> Column:
    v = _c(c).try_cast("long")
    if unit == "seconds":
        return F.timestamp_seconds(v)
    if unit == "millis":
        return F.timestamp_millis(v)
    raise ValueError(f"unknown unit {unit!r}")


# P9 ---------------------------------------------------------------------------
# The date formats of the review table's date field, in order.
REVIEW_DATE_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"]


def parse_multi_format_ts(c: ColumnOrName, formats: Sequence[str] = tuple(REVIEW_DATE_FORMATS),
                          epoch_unit: str | None = "millis") -> Column:
    """First format that parses wins; an all-digit string is an epoch value."""
    s = _c(c).cast("string")
    tries = [F.try_to_timestamp(s, F.lit(f)) for f in formats]
    if epoch_unit:
        digits = F.when(s.rlike(r"^-?[0-9]+$"), epoch_to_timestamp(s, epoch_unit))
        tries.append(digits)
    return F.coalesce(*tries)


# P10 / P11 ----------------------------------------------------------------------
def increment(c: ColumnOrName, by: int = 1) -> Column:
    return F.coalesce(_c(c), F.lit(0)) + F.lit(by)


def incremental_mean(old_mean: ColumnOrName, old_count: ColumnOrName, x: ColumnOrName) -> Column:
    """(mean*n + x)/(n+1); x widened to double with try_cast (decision Q17)."""
    n = F.coalesce(_c(old_count), F.lit(0)).cast("double")
    m = F.coalesce(_c(old_mean), F.lit(0.0)).cast("double")
    return (m * n + _c(x).try_cast("double")) / (n + F.lit(1.0))


# P13 ----------------------------------------------------------------------------
def safe_cast(c: ColumnOrName, to: str) -> Column:
    return _c(c).try_cast(to)


# P17 / P18 ------------------------------------------------------------------------
def highlight(avg: ColumnOrName, threshold: float = 4.0) -> Column:
    return _c(avg) >= F.lit(threshold)


def two_decimals(c: ColumnOrName) -> Column:
    """Average shown with two decimals: the exact binary value rounded once, ties away from zero.

    The value is split into a high and a low part whose products with 100 are
    exact doubles, so the comparison with the half is exact too.
    """
    x = F.abs(_c(c).cast("double"))
    wide = x * F.lit(134217729.0)  # 2**27 + 1
    high = wide - (wide - x)
    p, rest = high * F.lit(100.0), (x - high) * F.lit(100.0)
    whole = F.floor(p + rest).cast("double")
    cents = (whole + F.when(p - whole - F.lit(0.5) >= -rest, F.lit(1.0)).otherwise(F.lit(0.0))).cast("long")
    sign = F.when(_c(c) < 0, F.lit("-")).otherwise(F.lit(""))
    text = F.format_string("%s%d.%02d", sign, F.floor(cents / 100).cast("long"), cents % 100)
    return F.when(x < F.lit(1e15), text).otherwise(_c(c).cast("decimal(38,2)").cast("string"))


def genre_text(genres: ColumnOrName, sep: str = ", ") -> Column:
    return F.array_join(_c(genres), sep)


# P19 ----------------------------------------------------------------------------
def capitalize_words(c: ColumnOrName) -> Column:
    """Upper-case the first letter of each space-separated word, keep the rest,
    and end with one space (the reference behaviour); not ``initcap``."""
    words = F.split(_c(c), " ", -1)
    caps = F.transform(words, lambda w: F.concat(F.upper(w.substr(F.lit(1), F.lit(1))),
                                                 w.substr(F.lit(2), F.length(w))))
    return F.concat(F.array_join(caps, " "), F.lit(" "))


# P20 ----------------------------------------------------------------------------
def explode_recommendations(df: DataFrame, col: str = "recommendations",
                            keep: Sequence[str] = ("user_id",)) -> DataFrame:
    """array<struct<item_id, rating>> -> one row per (user, item, rating)."""
    return df.select(*keep, F.inline(F.col(col)))


# Text tokens ------------------------------------------------------------------------
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def tokens(c: ColumnOrName) -> Column:
    """Lower-cased letter/digit runs; the analyser used by text match."""
    return F.filter(F.split(F.lower(_c(c)), TOKEN_SPLIT, -1), lambda t: t != F.lit(""))
