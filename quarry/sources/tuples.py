"""Lines of Python tuple text, ``('7', 10.5, None)``, read back under a schema; the inverse of ``sinks.write_tuple_text``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.sinks import TUPLE_ESCAPES

# A field: a string in either quotes, in which a backslash hides the next character, or whatever stands up to the next comma.
# The repetitions never give back what they took, so a field of any length is scanned once.
FIELD = r"""'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^\s,()'"][^,()'"]*+"""


def _unquoted(raw: Column) -> Column:
    """The value of a quoted string; each backslash pair is read once, from the left."""
    body = F.substring(raw, F.lit(2), F.length(raw) - 2)
    # cut at the doubled backslashes: what is left between them are the other pairs
    parts = F.split(body, r"\\\\")

    def plain(part: Column) -> Column:
        for char, code in (*TUPLE_ESCAPES[1:], ("'", "\\'"), ('"', '\\"')):
            part = F.replace(part, F.lit(code), F.lit(char))
        return part

    return F.array_join(F.transform(parts, plain), "\\")


def tuple_fields(line: Column | str) -> Column:
    """The raw fields of a tuple line, quotes included, as an array."""
    return F.regexp_extract_all(F.col(line) if isinstance(line, str) else line, F.lit(FIELD), F.lit(0))


def parse_tuples(df: DataFrame, col: str, schema: StructType | str) -> DataFrame:
    """A column of tuple lines as the columns of ``schema``. ``None`` is null; a bad value, or another number of fields, raises."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    n = len(schema.fields)
    fields = tuple_fields(col)
    whole = F.when(F.size(fields) == n, fields).otherwise(
        F.raise_error(F.concat(F.lit(f"a tuple line must have {n} fields: "), F.coalesce(F.substring(F.col(col), 1, 200), F.lit("null"))))
    )
    rows = df.select(whole.alias("fields"))
    out = []
    for i, field in enumerate(schema.fields):
        raw = F.get(F.col("fields"), i)
        typ = field.dataType.simpleString()
        value = _unquoted(raw) if typ == "string" else F.when(F.substring(raw, 1, 1).isin("'", '"'), _unquoted(raw)).otherwise(raw).cast(typ)
        out.append(F.when(raw != "None", value).alias(field.name))
    return rows.select(*out)


def read_tuple_text(spark: SparkSession, path: str | Sequence[str], schema: StructType | str) -> DataFrame:
    """Files of tuple lines; a line is a row, so files are split between tasks."""
    return parse_tuples(spark.read.text(path), "value", schema)
