"""Totals that the writing job counts itself (A3, A5, Q5): no second pass over the rows."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Observation


def write_observed(df: DataFrame, write: Callable[[DataFrame], Any], **measures: Column) -> dict[str, Any]:
    """Run ``write`` on ``df`` and return the ``measures`` (aggregates without DISTINCT) over the rows written."""
    seen = Observation()
    write(df.observe(seen, *[m.alias(name) for name, m in measures.items()]))
    return seen.get
