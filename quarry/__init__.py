"""quarry: batch analytics on Spark, written as DataFrame -> DataFrame functions.

Layout
------
``sources``    readers for delimited, split-text, JSON and Parquet inputs
``sinks``      CSV / text writers with controlled file layout
``functions``  column expressions: exact money arithmetic, dates, text
``operators``  reusable relational building blocks (top-n, rows at an extreme,
               unmatched rows, shares, conforming and union, word count)
``plans``      the composite questions (hotel revenue, retail, prices, ratings,
               walkthrough) over the test tables, the job runner, and the
               original jobs on their own file layouts (``plans.jobs``)
``streaming``  the word count over a growing directory of text files

Library functions never build a session, never ``collect`` whole data and never
call ``show``; they return DataFrames and let Catalyst plan them.
"""

__all__ = ["functions", "operators", "sources", "sinks", "plans", "streaming"]
