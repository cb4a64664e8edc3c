"""A schema kept beside the data as JSON, and checked against the files when they are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from quarry.sources.rows import schema_from_json, schema_json


class SchemaDrift(ValueError):
    """The files do not have the schema stored beside them."""


def schema_path(path: str) -> str:
    """Where the schema of the data at ``path`` lies: a text file of its own folder, read and written by Spark like the data."""
    return f"{path.rstrip('/')}.schema"


def write_with_schema(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet files, and their schema as JSON beside them."""
    df.write.mode(mode).parquet(path)
    text = df.sparkSession.createDataFrame([(schema_json(df),)], "value string")
    text.coalesce(1).write.mode(mode).text(schema_path(path))


def stored_schema(spark: SparkSession, path: str) -> StructType:
    """The schema written beside the data."""
    return schema_from_json(spark.read.text(schema_path(path)).first()["value"])


def drift(stored: StructType, found: StructType) -> list[str]:
    """How ``found`` departs from ``stored``: columns gone, new, or of another type. Nullability and order do not count."""
    was, now = ({f.name: f.dataType.simpleString() for f in s.fields} for s in (stored, found))
    out = [f"{c} {was[c]} is gone" for c in was if c not in now]
    out += [f"{c} {now[c]} is new" for c in now if c not in was]
    return out + [f"{c} was {was[c]}, is {now[c]}" for c in was if c in now and was[c] != now[c]]


def read_with_schema(spark: SparkSession, path: str, every_file: bool = True) -> DataFrame:
    """The data at ``path`` under the schema stored beside it; raises ``SchemaDrift`` if the files have another.

    ``every_file`` reads the footers of all files (a Spark job), else of one.
    """
    stored = stored_schema(spark, path)
    try:
        found = spark.read.option("mergeSchema", every_file).parquet(path).schema
    except Exception as e:
        if "MERGE" in str(e).upper():  # files of one table disagree among themselves
            raise SchemaDrift(f"{path}: files of different types") from e
        raise
    if changes := drift(stored, found):
        raise SchemaDrift(f"{path}: {'; '.join(changes)}")
    return spark.read.schema(stored).parquet(path)
