"""Declared schemas and keyed-table definitions.

A search-index mapping (``{"mappings": {"properties": {...}}}``) converts
to a ``StructType``; tables are created with ``CREATE TABLE IF NOT EXISTS``
so running the set-up twice is harmless.
"""

from __future__ import annotations

import json
from collections.abc import Collection
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import types as T

S = T.StringType

# The event record as published (every leaf is a string).
EVENT_SCHEMA = T.StructType([
    T.StructField("movie", T.StructType([
        T.StructField("genres", T.ArrayType(S())),
        T.StructField("movieId", S()),
        T.StructField("title", S()),
    ])),
    T.StructField("rating", S()),
    T.StructField("timestamp", S()),
    T.StructField("user", T.StructType([
        T.StructField("age", S()),
        T.StructField("gender", S()),
        T.StructField("occupation", S()),
        T.StructField("userId", S()),
    ])),
])

# Mapping field types and the Spark types they become.
# Counters widen to long and averages to double (cast back only at a sink).
MAPPING_TYPES = {
    "keyword": T.StringType(),
    "text": T.StringType(),
    "integer": T.LongType(),
    "long": T.LongType(),
    "float": T.DoubleType(),
    "double": T.DoubleType(),
    "date": T.TimestampType(),
    "boolean": T.BooleanType(),
}

# Fixed value: the field that holds a list although the mapping declares a scalar type.
ARRAY_FIELDS = ("genres",)


def mapping_to_schema(mapping: dict, array_fields: Collection[str] = ARRAY_FIELDS) -> T.StructType:
    """Convert a mapping document (or its ``properties``) to a StructType.

    A mapping does not say whether a field holds one value or a list:
    ``array_fields`` names those that hold lists.
    """
    props = mapping.get("mappings", mapping).get("properties", mapping.get("properties"))
    if props is None:
        raise ValueError("mapping has no properties")
    fields = []
    for name, spec in props.items():
        if "properties" in spec:
            dt: T.DataType = mapping_to_schema(spec, array_fields)
        else:
            kind = spec.get("type", "object")
            if kind not in MAPPING_TYPES:
                raise ValueError(f"unsupported mapping type {kind!r} for {name}")
            dt = MAPPING_TYPES[kind]
            if name in array_fields:
                dt = T.ArrayType(dt)
        fields.append(T.StructField(name, dt, True))
    return T.StructType(fields)


def load_mapping(path: str | Path, array_fields: Collection[str] = ARRAY_FIELDS) -> T.StructType:
    return mapping_to_schema(json.loads(Path(path).read_text()), array_fields)


def create_table_if_absent(spark: SparkSession, name: str, schema: T.StructType,
                           location: str | None = None, fmt: str = "parquet") -> bool:
    """Create an empty table; an existing table is left as it is.
    Returns True if the table exists afterwards."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING {fmt}{loc}")
    return spark.catalog.tableExists(name)


def drop_table(spark: SparkSession, name: str) -> bool:
    """Drop if present; returns True if the table is gone afterwards."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return not spark.catalog.tableExists(name)


def create_tables_from_mappings(spark: SparkSession, folder: str | Path,
                                location_root: str | None = None,
                                array_fields: Collection[str] = ARRAY_FIELDS) -> dict[str, bool]:
    """One table per ``*.json`` mapping in ``folder`` (table name = file stem);
    tables that exist already are left alone."""
    out = {}
    for f in sorted(Path(folder).glob("*.json")):
        loc = f"{location_root.rstrip('/')}/{f.stem}" if location_root else None
        out[f.stem] = create_table_if_absent(spark, f.stem, load_mapping(f, array_fields), loc)
    return out


def drop_tables_from_mappings(spark: SparkSession, folder: str | Path) -> dict[str, bool]:
    return {f.stem: drop_table(spark, f.stem) for f in sorted(Path(folder).glob("*.json"))}
