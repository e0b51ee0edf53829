"""The Python-UDF surface, as an Arrow-batched pandas UDF.

The native ``capitalize_words`` column expression is what the library uses;
this twin exists for callers who register Python string functions, and it
processes whole Arrow batches, never one row per call.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _capitalize_batch(s: pd.Series) -> pd.Series:
    """Upper-case every non-space that begins the string or follows a space, and add one space."""
    return s.str.replace(r"(?:^|(?<= ))[^ ]", lambda m: m.group().upper(), regex=True) + " "


def capitalize_words_udf(c: Column | str) -> Column:
    """Apply the pandas UDF (built lazily, so importing needs no session)."""
    return F.pandas_udf(_capitalize_batch, "string")(c)
