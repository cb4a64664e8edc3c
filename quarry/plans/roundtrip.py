"""Readers and writers checked on whole tables: write a table in a text format,
read it back under a declared schema, and compare with the table.

Each call writes to a fresh folder under the session's reliable checkpoint
directory (``spark.checkpoint.dir``, a shared folder on a cluster), so runs
never overwrite files another reader still uses. The write happens when the
function is called; the returned read is lazy, so the files must outlive it:
they sit in the application's own checkpoint subfolder, which can be removed
once the application has ended.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quarry.plans import walkthrough
from quarry.session import ensure_checkpoint_dir
from quarry.sinks import write_csv, write_tuple_text
from quarry.sources.delimited import (
    HIVE_TEXT_SEP,
    join_fields,
    read_delimited,
    read_headed_lines,
    read_hive_text,
    read_split_text,
)
from quarry.sources.inferred import read_inferred
from quarry.sources.json import read_json
from quarry.sources.schemas import read_with_schema, write_with_schema
from quarry.sources.tuples import read_tuple_text

# The separators of the delimited formats.
HASH_SEP = "#"
SEMICOLON_SEP = ";"
# How the files write a null, so that an empty string stays one.
NULL = "\\N"


def scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/roundtrip/{name}-{uuid.uuid4().hex}"


def hash_separated(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Headerless ``#`` file under a declared schema."""
    path = scratch(spark, "hash")
    write_csv(df, path, header=False, sep=HASH_SEP, null=NULL, escaped=True)
    return read_delimited(spark, path, sep=HASH_SEP, schema=df.schema, null=NULL, escaped=True)


def semicolon_with_header(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``;`` file with a header line, read under a declared schema."""
    path = scratch(spark, "semicolon")
    write_csv(df, path, header=True, sep=SEMICOLON_SEP, null=NULL, escaped=True)
    return read_delimited(spark, path, sep=SEMICOLON_SEP, header=True, schema=df.schema, null=NULL, escaped=True)


def hive_text(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Hive's default text table layout (``\\x01``, no header)."""
    path = scratch(spark, "hive")
    write_csv(df, path, header=False, sep=HIVE_TEXT_SEP, null=NULL, escaped=True)
    return read_hive_text(spark, path, df.schema, null=NULL, escaped=True)


def double_colon_lines(spark: SparkSession, df: DataFrame, sep: str = "::") -> DataFrame:
    """Plain text lines joined with a multi-character separator, split back in one projection."""
    path = scratch(spark, "lines")
    df.select(join_fields(df.columns, sep, escaped=True).alias("value")).write.text(path)
    return read_split_text(spark, path, sep, df.schema, escaped=True)


def nested_json(spark: SparkSession, supplier: DataFrame) -> DataFrame:
    """Supplier documents as JSON lines, read under the declared nested schema and flattened."""
    path = scratch(spark, "json")
    walkthrough.supplier_documents(supplier).write.text(path)
    return walkthrough.flatten_suppliers(read_json(spark, path, walkthrough.SUPPLIER_DOC_SCHEMA))


def inferred_comma_separated(spark: SparkSession, df: DataFrame, sample: float = 0.1) -> DataFrame:
    """``,`` file with a header line, its types inferred from a sample and checked on every line."""
    path = scratch(spark, "comma")
    write_csv(df, path, escaped=True)
    return read_inferred(spark, path, sample=sample, escaped=True)


def headed_lines(spark: SparkSession, df: DataFrame, files: int = 4) -> DataFrame:
    """Several ``;`` files, each with a header line, read as plain text lines: header lines go, blanks are null, values are cast."""
    path = scratch(spark, "headed")
    write_csv(df, path, files=files, sep=SEMICOLON_SEP)
    return read_headed_lines(spark, path, SEMICOLON_SEP.join(df.columns), SEMICOLON_SEP, df.schema)


def tuple_lines(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Rows saved as Python tuple text, one per line, and read back."""
    path = scratch(spark, "tuples")
    write_tuple_text(df, path)
    return read_tuple_text(spark, path, df.schema)


def stored_schema(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Parquet files with their schema beside them as JSON, read under the stored schema after a check for drift."""
    path = scratch(spark, "schema")
    write_with_schema(df, path)
    return read_with_schema(spark, path)
