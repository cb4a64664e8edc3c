import os
from collections import Counter

from conftest import write_text
from quarry.operators.wordcount import word_count
from quarry.sources import read_lines

TEXT = (
    "But soft what light through yonder window breaks\n"
    "\n"
    "   It is the east and Juliet is the sun\n"
    "Arise  fair sun and\tkill the envious moon\n"
    "Who is already sick and pale with grief \n"
    "\f\r\n"
)


def test_word_count_matches_whitespace_tokenizer(spark, scratch):
    path = write_text(os.path.join(scratch, "poem.txt"), TEXT)
    got = dict(word_count(read_lines(spark, path), "value").collect())
    want = Counter(TEXT.split())  # ASCII whitespace only in this text
    assert got == dict(want)
    assert "" not in got


def test_word_count_of_whole_long_text(spark):
    # one text far beyond any prefix length: every token counts
    text = " ".join(["alpha"] * 20000 + ["omega"])
    df = spark.createDataFrame([(text,), ("omega  omega",)], "value string")
    got = dict(word_count(df).collect())
    assert got == {"alpha": 20000, "omega": 3}


def test_word_count_of_empty_input(spark):
    df = spark.createDataFrame([], "value string")
    assert word_count(df).count() == 0


def test_word_count_shape_of_a_short_poem(spark):
    # 94 tokens over 12 lines, 85 distinct: 76 words once, 9 words twice
    once = [f"w{i}" for i in range(76)]
    twice = [f"r{i}" for i in range(9)] * 2
    tokens = once + twice
    lines = [" ".join(tokens[i::12]) for i in range(12)]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    counts = word_count(df)
    assert counts.count() == 85
    assert counts.agg({"occurrences": "sum"}).first()[0] == 94
