"""Registered queries over the driver tables, each with its SQL twin.

Every query reads the whole tables (or data Spark derives from them) and
returns a DataFrame; ``SQL`` holds the DuckDB statement that must give the
same rows.  Queries without a SQL twin (model fitting, streams whose
output depends on a trained model) are checked by row count and pytest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from ratecraft.plans import (  # noqa: F401
        q_core, q_recommend, q_stream, q_text, q_windows)
