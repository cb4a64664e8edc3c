"""Enlarge a table by copies, and the midpoint transformation of the laziness demo."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The transformation modes.
MODES = ("noop", "col", "full")


def replicate(df: DataFrame, copies: int) -> DataFrame:
    """Every row ``copies`` times.

    A generator in the same stage as the scan (``explode`` of a constant
    sequence): no union of ``copies`` plan branches, no join and no shuffle.
    """
    if copies < 1:
        raise ValueError("copies must be >= 1")
    return df.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("__copy")


def midpoint(df: DataFrame, lower: str = "lcl", upper: str = "ucl", mode: str = "col") -> DataFrame:
    """Add ``avg = (lower + upper) / 2`` and copies of both bounds.

    ``noop`` leaves the table as is; ``full`` adds the columns and drops them
    again (Catalyst removes the work, which the plan shows).
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "noop":
        return df
    lo, up = (name.replace("`", "``") for name in (lower, upper))
    out = df.withColumns(
        {
            "avg": F.expr(f"(`{lo}` + `{up}`) / 2"),
            f"{lower}2": F.col(f"`{lo}`"),
            f"{upper}2": F.col(f"`{up}`"),
        }
    )
    if mode == "full":
        out = out.drop("avg", f"{lower}2", f"{upper}2")
    return out
