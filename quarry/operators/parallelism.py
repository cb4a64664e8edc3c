"""Spread CPU-heavy row work of an input in few files over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, tasks: int) -> DataFrame:
    """Deal the rows round-robin over ``tasks`` tasks.

    For an input in one small file (one Parquet row group is one task). The caller
    decides: a large input has more splits than cores, and its rows should not move for this.
    """
    return df.repartition(tasks)
