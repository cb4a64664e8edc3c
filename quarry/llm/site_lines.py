"""Line removal by site-relative frequency.

A line of a page is boilerplate when the share of its host's pages that hold it
exceeds ``ratio`` (and at least ``min_pages`` pages do). Lines are compared
without surrounding spaces, tabs and carriage returns. Blank lines are never
counted nor dropped.

The counts are partial sums per host and line, so a host or a line that a third
of all pages share costs each task one row. A host has at most (mean lines per
page) / ratio boilerplate lines; they come back to the pages as one array per
host, broadcast while all of them together stay under ``BROADCAST_LINES``, else
by a join that deals each host's pages over ``SALTS`` salts.

Defined results: a null text stays null; an empty text stays empty; all pages
without a host form one group; repeated rows count as pages of their own; an
empty table gives an empty result; every column of the input is kept, with only
the text replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stored

BROADCAST_LINES = 500_000  # 8 bytes each
SALTS = 64


def _key(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\r"))


def boilerplate_lines(pages: DataFrame, ratio: float, min_pages: int) -> DataFrame:
    """(host, bad) from ``pages`` (host, text): per host the hashes of its boilerplate lines."""
    keys = F.array_distinct(F.filter(F.transform(F.split("text", "\n"), _key), lambda k: k != ""))
    held = pages.select("host", F.explode(F.transform(keys, lambda k: F.xxhash64(k))).alias("line")).groupBy("host", "line").agg(F.count("*").alias("n"))
    totals = pages.groupBy("host").agg(F.count("*").alias("total"))
    often = held.where(F.col("n") >= min_pages).alias("a").join(totals.alias("b"), F.col("a.host").eqNullSafe(F.col("b.host")))
    return (
        often.where(F.col("n") > F.lit(ratio) * F.col("total"))
        .groupBy(F.col("a.host").alias("host")).agg(F.collect_list("line").alias("bad"))
    )


def drop_site_lines(
    docs: DataFrame, host: Column, text_col: str = "text", ratio: float = 0.005, min_pages: int = 3,
    counts: tuple[str, str] | None = None, broadcast_lines: int = BROADCAST_LINES,
) -> DataFrame:
    """``docs`` with the boilerplate lines of each host taken out of ``text_col``.

    ``counts`` names two more columns: the lines of the text, and those dropped.
    """
    rows = docs.select(F.struct("*").alias("row"), host.alias("host"), F.col(text_col).alias("text"))
    bad = stored(boilerplate_lines(rows.select("host", "text"), ratio, min_pages), "site-lines")
    size = bad.agg(F.sum(F.size("bad") + F.lit(2))).first()[0] or 0
    if size <= broadcast_lines:
        joined = rows.alias("a").join(F.broadcast(bad.alias("b")), F.col("a.host").eqNullSafe(F.col("b.host")), "left")
    else:
        salt = F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int")
        spread = bad.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
        joined = rows.withColumn("salt", salt).alias("a").join(
            spread.alias("b"), F.col("a.host").eqNullSafe(F.col("b.host")) & (F.col("a.salt") == F.col("b.salt")), "left"
        )
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda x: ~F.array_contains("bad", F.xxhash64(_key(x))) | (_key(x) == ""))
    new = F.when(F.col("bad").isNull() | F.col("text").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    out = joined.select("row", new.alias("new"), F.coalesce(F.size(lines), F.lit(0)).alias("n"), F.when(
        F.col("bad").isNull() | F.col("text").isNull(), 0).otherwise(F.size(lines) - F.size(kept)).alias("dropped"))
    cols = [F.col("new").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns]
    more = [F.col("n").alias(counts[0]), F.col("dropped").alias(counts[1])] if counts else []
    return out.select(*cols, *more)


SITE_LINES_SQL = """
WITH lines AS (
  SELECT doc_id, source, pos, raw, trim(raw, E' \\t\\r') AS k
  FROM (SELECT doc_id, source, unnest(string_split(text, E'\\n')) AS raw,
               generate_subscripts(string_split(text, E'\\n'), 1) AS pos
        FROM documents WHERE text IS NOT NULL)
), totals AS (SELECT source, count(*) AS total FROM documents GROUP BY source),
held AS (SELECT source, k, count(DISTINCT doc_id) AS n FROM lines WHERE k <> '' GROUP BY source, k),
bad AS (
  SELECT h.source, h.k FROM held h JOIN totals t ON h.source IS NOT DISTINCT FROM t.source
  WHERE h.n >= 3 AND h.n > 0.005 * t.total
), marked AS (
  SELECT l.*, b.k IS NOT NULL AS dropped
  FROM lines l LEFT JOIN bad b ON l.source IS NOT DISTINCT FROM b.source AND l.k = b.k
), kept AS (
  SELECT doc_id, count(*)::INT AS n_lines, count(*) FILTER (dropped)::INT AS n_dropped,
         coalesce(string_agg(raw, E'\\n' ORDER BY pos) FILTER (NOT dropped), '') AS text
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, k.text, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_dropped, 0) AS n_dropped
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
