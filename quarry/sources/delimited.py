"""Delimited text: header + inferred types, declared schema, or split lines.

Schemas are declared wherever the layout is known: inference reads the data
an extra time before the job starts, which at scale is a full pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.functions.text import join_breaks, restore_breaks, split_literal

# The separator of Hive's default text table format.
HIVE_TEXT_SEP = "\x01"
# How escaped lines write a null.
ESCAPED_NULL = "\\N"


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ",",
    header: bool = False,
    schema: StructType | str | None = None,
    infer: bool = False,
    trim: bool = False,
    null: str = "",
    multiline: bool = False,
    escaped: bool = False,
) -> DataFrame:
    """CSV-family reader.

    With ``schema`` the file is read under it (no inference pass). With
    ``header`` and ``infer`` the types are inferred, as an option only.
    ``trim`` drops blanks around values (CSV keeps leading blanks otherwise).
    A blank field is null unless ``null`` names another marker; CRLF line ends are
    accepted. Values that hold line breaks need one of two: ``escaped`` undoes in a projection what ``write_csv(escaped=True)``
    wrote, so a large file is still split between tasks; ``multiline`` reads quoted breaks as they are, a file per task.
    """
    reader = spark.read.option("sep", sep).option("header", header).option("escape", '"').option("nullValue", null)
    if multiline:
        reader = reader.option("multiLine", True).option("lineSep", "\n")
    if trim:
        reader = reader.option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    df = reader.csv(path)
    return restored(df) if escaped else df


def restored(df: DataFrame) -> DataFrame:
    """Every string column with its line breaks and backslashes back."""
    return df.select(*[restore_breaks(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])


def read_typed(spark: SparkSession, path: str | Sequence[str], types: Mapping[str, str], sep: str = ",") -> DataFrame:
    """A file with a header line, all columns kept; those named in ``types`` are cast to the declared type.

    No inference pass; a value that is not of its declared type raises, and blanks are null. Other columns are strings.
    """
    df = read_delimited(spark, path, sep=sep, header=True)
    return df.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns])


def read_hive_text(
    spark: SparkSession, path: str, schema: StructType | str, null: str = "", multiline: bool = False, escaped: bool = False
) -> DataFrame:
    """A Hive text table directory (``\\x01``-separated, no header)."""
    return read_delimited(spark, path, sep=HIVE_TEXT_SEP, schema=schema, null=null, multiline=multiline, escaped=escaped)


def read_lines(spark: SparkSession, path: str | Sequence[str], skip_prefix: str | None = None) -> DataFrame:
    """One ``value`` row per line; optionally drop lines starting with a prefix (a header)."""
    df = spark.read.text(path)
    if skip_prefix:
        df = df.filter(~F.col("value").startswith(skip_prefix))
    return df


def read_headed_lines(
    spark: SparkSession, path: str | Sequence[str], header: str, sep: str, schema: StructType | str, strict: bool = True
) -> DataFrame:
    """Lines split on ``sep`` under ``schema``, without the header line that each of the files starts with.

    A header line is one that starts with ``header``, in whichever file or part of one it comes, so files may be many and
    split. A blank field is null, in string columns too, before it is cast. The prefix test reaches the scan as a filter.
    """
    lines = read_lines(spark, path, skip_prefix=header)
    df = split_to_schema(lines, "value", sep, schema, strict)
    return df.select(*[F.when(F.trim(F.col(f"`{c}`")) != "", F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])


def split_to_schema(
    df: DataFrame,
    col: str,
    sep: str,
    schema: StructType | str,
    strict: bool = True,
    escaped: bool = False,
) -> DataFrame:
    """Split a text column on a literal (possibly multi-character) separator and
    cast each position to the declared field type, in one projection.

    ``strict`` casts raise on a bad value (as ``int(x)`` would); otherwise a bad
    value becomes null. A missing position, or a blank one in a non-string
    field, is null either way. ``escaped`` undoes what ``join_fields(escaped=True)`` wrote.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    parts = split_literal(col, sep)
    out: list[Column] = []
    for i, field in enumerate(schema.fields):
        raw = F.get(parts, i)
        if escaped:
            raw = F.when(raw != F.lit(ESCAPED_NULL), _unescaped(raw, sep))
        typ = field.dataType.simpleString()
        if typ == "string":
            val = raw
        else:
            present = F.nullif(F.trim(raw), F.lit(""))
            val = present.cast(typ) if strict else present.try_cast(typ)
        out.append(val.alias(field.name))
    return df.select(*out)


def read_split_text(
    spark: SparkSession, path: str | Sequence[str], sep: str, schema: StructType | str, strict: bool = True, escaped: bool = False
) -> DataFrame:
    """Text lines split on ``sep`` (e.g. ``::``) and cast to ``schema``; no Python per row."""
    return split_to_schema(spark.read.text(path), "value", sep, schema, strict, escaped)


def _escaped(c: Column, sep: str) -> Column:
    return F.replace(join_breaks(c), F.lit(sep[0]), F.lit("\\s"))


def _unescaped(c: Column, sep: str) -> Column:
    return restore_breaks(F.replace(c, F.lit("\\s"), F.lit(sep[0])))


def join_fields(cols: Sequence[str], sep: str, escaped: bool = False) -> Column:
    """Inverse of ``split_to_schema``: one text line.

    Null fields become empty, and values must hold neither separator nor line break; with
    ``escaped`` any value survives: backslash, line breaks and the separator's first character are
    written as two characters, null as ``\\N``.
    """
    if escaped:
        return F.concat_ws(sep, *[F.coalesce(_escaped(F.col(c).cast("string"), sep), F.lit(ESCAPED_NULL)) for c in cols])
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
