"""Small driver-held rows as a table (literals, tests, lookup lists)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def rows_frame(spark: SparkSession, rows: Iterable, schema: StructType | str) -> DataFrame:
    """``createDataFrame`` under a declared schema; an empty list gives an empty table."""
    return spark.createDataFrame(list(rows), schema)


def schema_tree(df: DataFrame) -> str:
    """The schema as the indented tree ``printSchema`` shows, as text."""
    return df.schema.treeString()


def schema_json(df: DataFrame) -> str:
    """The schema as JSON text; ``schema_from_json`` reads it back."""
    return df.schema.json()


def schema_from_json(text: str) -> StructType:
    import json

    return StructType.fromJson(json.loads(text))
