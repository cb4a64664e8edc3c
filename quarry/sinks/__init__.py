"""Writers with controlled file layout.

``files`` bounds the number of output files. By default the bound is a
shuffle of the final rows (``repartition(n)``): only the result moves, and
every stage before it keeps its full parallelism. ``narrow=True`` uses
``coalesce(n)`` instead (no shuffle), which also shrinks the stage computing
the rows to ``n`` tasks; use it only when that stage is small anyway. Give a
file bound only to results whose size does not grow with the input (top-n,
global or calendar aggregates); large results are written one file per task.

Results that grow take ``rebalance`` and ``records``: rows with equal values of the columns come together in files of
about the adaptive advisory size, small groups share a file, and a value with more rows than that (one product with a
third of all sales) is split over several files and tasks; without columns, files are just filled. ``records`` bounds the
rows of a file.

``by`` hash-partitions the rows on columns first, so each file holds whole
keys; give it only where no key can be hot. ``sort_within`` orders the rows inside each file (a sorted result keeps
its order in a single file). ``partition_by`` writes one directory per value
for readers that prune partitions. Output goes through Spark's commit
protocol, so a task retried after a lost executor never leaves partial files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import join_breaks


# Characters that Python writes as two in a quoted string, and their codes.
TUPLE_ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"))


def layout(
    df: DataFrame,
    files: int | None = None,
    by: Sequence[str] = (),
    sort_within: Sequence[str] = (),
    narrow: bool = False,
    rebalance: Sequence[str] | None = None,
) -> DataFrame:
    if rebalance is not None:
        if by or files:
            raise ValueError("rebalance sizes files by itself; give neither files nor by")
        df = df.hint("rebalance", *rebalance)
    elif by:
        df = df.repartition(files, *by) if files else df.repartition(*by)
    elif files:
        df = df.coalesce(files) if narrow else df.repartition(files)
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    return df


def write_csv(
    df: DataFrame,
    path: str,
    files: int | None = None,
    by: Sequence[str] = (),
    header: bool = True,
    sep: str = ",",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    sort_within: Sequence[str] = (),
    narrow: bool = False,
    null: str = "",
    escaped: bool = False,
    rebalance: Sequence[str] | None = None,
    records: int | None = None,
) -> None:
    """CSV files. Values keep their blanks; those with separators, quotes or line breaks are quoted.

    Null is written as ``null``. With the default, a blank, the reader cannot tell null from an empty string.
    ``escaped`` writes line breaks and backslashes in strings as two characters, so that every row is one line and readers
    can split the file; ``read_delimited(escaped=True)`` gives the values back.
    """
    df = layout(df, files, by, sort_within, narrow, rebalance)
    if escaped:
        df = df.select(*[join_breaks(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])
    w = df.write.mode(mode).option("header", header).option("sep", sep)
    if records:
        w = w.option("maxRecordsPerFile", records)
    w = w.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    w = w.option("escape", '"').option("nullValue", null).option("emptyValue", '""').option("lineSep", "\n")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def _quoted(c):
    """A string as Python writes it in a tuple: single quotes, or double quotes when it holds a single quote and no
    double quote; backslashes, line breaks and tabs as two characters, so a row stays one line."""
    body = c
    for plain, code in TUPLE_ESCAPES:
        body = F.replace(body, F.lit(plain), F.lit(code))
    single = F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'"))
    double = F.concat(F.lit('"'), body, F.lit('"'))
    return F.when(F.contains(c, F.lit("'")) & ~F.contains(c, F.lit('"')), double).otherwise(single)


def write_tuple_text(df: DataFrame, path: str, files: int | None = None, mode: str = "errorifexists") -> None:
    """Rows as tuple text lines, ``('7', 10.5)``: strings quoted, numbers bare,
    nulls as ``None``; by default fails when ``path`` exists."""
    fields = []
    for name, typ in df.dtypes:
        c = F.col(name)
        text = _quoted(c) if typ == "string" else c.cast("string")
        fields.append(F.coalesce(text, F.lit("None")))
    line = F.concat(F.lit("("), F.concat_ws(", ", *fields), F.lit(",)" if len(fields) == 1 else ")"))
    layout(df.select(line.alias("value")), files).write.mode(mode).text(path)


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (), records: int | None = None
) -> DataFrame:
    """Parquet files; returns the DataFrame that reads them back (pruned columns, pushed filters).

    With ``partition_by`` there is one folder per value, and a filter or join on those columns lists and reads only the folders it
    needs. Rows are rebalanced on the columns first, so a folder holds a few files of the advisory size: not one from every
    task, and not all of a hot value from one task. ``records`` bounds the rows of a file.
    """
    w = layout(df, rebalance=partition_by or None).write.mode(mode)
    if records:
        w = w.option("maxRecordsPerFile", records)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> DataFrame:
    """Write ``df`` as a Parquet table bucketed (and sorted) by ``key`` at ``path``.

    The table is registered in the session catalog under ``name``; reading it
    back gives a scan already hash-partitioned on ``key`` into ``buckets``
    parts, so aggregates on ``key`` and joins with another table bucketed the
    same way need no shuffle. Writing costs one shuffle, paid once for every
    later job that reads the table.
    """
    (
        df.write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)
