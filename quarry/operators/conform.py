"""Conform sources of different layout to one schema, then unite them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conform(
    df: DataFrame,
    columns: Mapping[str, Column | str],
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """One ``select`` producing exactly ``columns`` in order.

    Values are column names (renames), nested paths such as ``"fields.name"``
    (flattening) or expressions (constants, computed ids). ``None`` stands for a
    typed null column; its type comes from ``types`` (default string), so the
    result can be written to CSV and united with sources that have the column.
    """
    types = dict(types or {})
    out = []
    for name, src in columns.items():
        if src is None:
            expr = F.lit(None).cast(types.get(name, "string"))
        elif isinstance(src, str):
            expr = F.col(src)
        else:
            expr = src
        if name in types and src is not None:
            expr = expr.cast(types[name])
        out.append(expr.alias(name))
    return df.select(*out)


def composite_id(parts: Sequence[Column | str], sep: str = "_") -> Column:
    """``concat`` of parts with ``sep``; null when any part is null."""
    cols: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(sep))
        cols.append((F.col(p) if isinstance(p, str) else p).cast("string"))
    return F.concat(*cols)


def unite(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Union by column name, duplicates kept."""
    result = frames[0]
    for f in frames[1:]:
        result = result.unionByName(f, allowMissingColumns=allow_missing)
    return result
