"""Word count over whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import tokens


def word_count(df: DataFrame, text_col: str = "value") -> DataFrame:
    """(word, occurrences) over every token of every text.

    Tokens are maximal runs of non-blank characters, as a whitespace tokenizer
    gives them; empty pieces from leading blanks are dropped. The count is a
    partial + final aggregate, so a word that holds a third of all tokens is
    one row per task before the shuffle, never a hot partition.
    """
    return (
        df.select(F.explode(tokens(text_col)).alias("word"))
        .filter(F.col("word") != F.lit(""))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )
