"""Tables laid out by key, so that joins and groupings on it need no shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from ratecraft.session import work_dir

LEAST_BUCKETS, ROWS_PER_BUCKET = 8, 1_000_000


def buckets_for(rows: int) -> int:
    """Buckets for tables that join where they lie, the largest of ``rows`` rows: a task holds one bucket,
    so their number grows with the rows and not a bucket's size."""
    return max(LEAST_BUCKETS, -(-rows // ROWS_PER_BUCKET))


def write_bucketed(df: DataFrame, keys: Sequence[str], buckets: int, name: str | None = None,
                   path: str | None = None) -> DataFrame:
    """Write ``df`` as table ``name`` in ``buckets`` hash buckets of ``keys``, sorted inside, and return the table.

    Tables with the same number of buckets on the same key types join where they
    lie.  Rows are shuffled once, so that a bucket is one file and its order
    holds; a hot key makes a large bucket, so keys that hold a large share of the
    rows are better joined unbucketed, where skew is split at run time.
    ``path`` is a work folder unless given.
    """
    spark = df.sparkSession
    name = name or f"bucketed_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path or work_dir(spark, name)).saveAsTable(name))
    return spark.table(name)
