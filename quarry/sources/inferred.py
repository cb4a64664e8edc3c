"""Column types of a delimited file with a header, inferred from a sample and widened where the rest does not fit.

A value's kind is the narrowest of BIGINT, DOUBLE, DATE, TIMESTAMP_NTZ, BOOLEAN and STRING that reads it; blanks have none.
A column's type is the narrowest that takes all its kinds: DOUBLE for whole and other numbers, TIMESTAMP_NTZ for days and
times, else STRING. Whole numbers are always BIGINT, so a type does not change when larger ones arrive.

Two passes, each one row of a few flags per column and task: the first over a sample of the lines names a type, the second over all
lines looks for kinds the type does not take. Nothing else reaches the driver, and no value is cast to a type it does not fit.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.delimited import read_delimited

# The kinds, and what a text of each looks like.
KINDS = ("bigint", "double", "date", "timestamp_ntz", "boolean", "string")
WHOLE = r"^[+-]?[0-9]{1,19}$"
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(NaN|Infinity)$"
DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?$"


def kind(text: Column) -> Column:
    """The kind of one text; null for a blank one."""
    t = F.trim(text)

    def reads(pattern: str, type_: str) -> Column:
        return t.rlike(pattern) & t.try_cast(type_).isNotNull()

    return (
        F.when(t.isNull() | (t == ""), None).when(reads(WHOLE, "bigint"), "bigint").when(reads(NUMBER, "double"), "double")
        .when(reads(DAY, "date"), "date").when(reads(TIME, "timestamp_ntz"), "timestamp_ntz")
        .when(F.lower(t).isin("true", "false"), "boolean").otherwise("string")
    )


def widest(kinds: Iterable[str]) -> str:
    """The narrowest type that takes all ``kinds``; STRING without any."""
    kinds = set(kinds)
    for type_, taken in (("bigint", {"bigint"}), ("double", {"bigint", "double"}), ("date", {"date"}), ("timestamp_ntz", {"date", "timestamp_ntz"}), ("boolean", {"boolean"})):
        if kinds and kinds <= taken:
            return type_
    return "string"


def _kinds_of(df: DataFrame, settled: Mapping[str, str] | None = None) -> dict[str, set[str]]:
    """The kinds that occur in each column, but for columns already STRING. One row of flags."""
    names = [c for c in df.columns if (settled or {}).get(c) != "string"]
    if not names:
        return {}
    flags = [F.max(F.coalesce(F.col(f"k{i}") == k, F.lit(False))).alias(f"k{i}_{k}") for i in range(len(names)) for k in KINDS]
    row = df.select(*[kind(F.col(f"`{c}`")).alias(f"k{i}") for i, c in enumerate(names)]).agg(*flags).first()
    return {c: {k for k in KINDS if row[f"k{i}_{k}"]} for i, c in enumerate(names)}


def infer_types(texts: DataFrame, sample: float = 0.1, seed: int = 1) -> dict[str, str]:
    """The type of every column of a DataFrame of strings: named from about ``sample`` of the rows, then widened over all rows."""
    if not 0 < sample <= 1:
        raise ValueError("sample must be above 0 and at most 1")
    if sample == 1:
        found = _kinds_of(texts)
        return {c: widest(found[c]) for c in texts.columns}
    first = _kinds_of(texts.sample(fraction=sample, seed=seed))
    named = {c: widest(first[c]) if first[c] else "" for c in texts.columns}
    every = _kinds_of(texts, named)
    return {c: widest(first[c] | every.get(c, set())) for c in texts.columns}


def typed(texts: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """String columns cast to ``types``; a blank is null but in string columns."""
    out = []
    for c in texts.columns:
        col = F.col(f"`{c}`")
        out.append((col if types.get(c, "string") == "string" else F.nullif(F.trim(col), F.lit("")).cast(types[c])).alias(c))
    return texts.select(*out)


def read_inferred(spark: SparkSession, path: str | Sequence[str], sep: str = ",", sample: float = 0.1, escaped: bool = False) -> DataFrame:
    """A delimited file with a header line under inferred types (see the module)."""
    texts = read_delimited(spark, path, sep=sep, header=True, escaped=escaped)
    return typed(texts, infer_types(texts, sample))
