from __future__ import annotations

import os

import pytest

from quarry.llm import tokens

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def ranks() -> str:
    return tokens.default_path()


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Null, empty, blank, tied, repeated and long texts, null ids, and columns named like helpers."""
    long_text = " ".join(f"word{i % 997} and{i}" for i in range(6000))
    base = "the quick brown fox jumps over the lazy dog near the old river bank today"
    rows = [
        (1, base, "en", "a"), (1, base, "en", "a"), (2, base.upper(), None, "a"), (3, None, "en", None), (4, "", "fr", None),
        (5, " \n\t ", "fr", "b"), (6, long_text, "en", "b"), (None, "no id here at all, really", None, "b"), (7, "12345 !!!", None, "b"),
        (8, "été à la plage où les élèves chantent\nété à la plage", "fr", "a"), (9, "日本語テキスト", None, "c"), (10, "one", "en", "c"),
    ]
    schema = "doc_id long, text string, lang string, source string"
    df = spark.createDataFrame(rows, schema)
    return df.selectExpr(
        "*", "1 AS n", "2 AS length", "'x' AS key", "3 AS sequence_id", "4 AS row", "5 AS host", "6 AS bad", "7 AS words", "8 AS rank",
        "9 AS held_out", "10L AS n_chars", "11 AS hit", "12 AS class", "13 AS score", "14 AS new",
    )


def brute_texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def data_file(name: str) -> str:
    return os.path.join(DATA, f"{name}.parquet")
