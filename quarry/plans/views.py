"""Named results as session views, and SQL over them with bound parameters."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def register(frames: Mapping[str, DataFrame]) -> list[str]:
    """Register each DataFrame as a temp view under its name (no data is stored)."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)


def query(spark: SparkSession, sql: str, **params: Any) -> DataFrame:
    """Run SQL over registered views; ``:name`` markers bind ``params`` (never pasted)."""
    return spark.sql(sql, args=params or None)


@contextmanager
def session_views(spark: SparkSession, frames: Mapping[str, DataFrame]) -> Iterator[list[str]]:
    """The frames as temp views while the block runs; dropped at its end, also after an error.

    A name that is taken raises, and nothing of the session's own is replaced or dropped. SQL is resolved when it is
    asked, so a DataFrame from ``query`` works on after its views are gone.
    """
    made: list[str] = []
    try:
        for name, df in frames.items():
            df.createTempView(name)
            made.append(name)
        yield list(made)
    finally:
        for name in made:
            spark.catalog.dropTempView(name)


def answer(spark: SparkSession, frames: Mapping[str, DataFrame], sql: str, **params: Any) -> DataFrame:
    """One SQL question over several named frames; no view is left."""
    with session_views(spark, frames):
        return query(spark, sql, **params)
