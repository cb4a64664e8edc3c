"""Runs of repeated words against a search of every period and start."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import periodic_runs
from quarry.llm.periodic_runs import find_runs
from quarry.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, least=6, exponent=4):
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute_row(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        a, p = (h // 10) % n, 1
        p += (n - a) // (3 + (h // 10) % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else None
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (
        "".join(f"{s},{size},{q}\n" for s, size, q in runs), " ".join(w for i, w in enumerate(words) if i not in gone))]
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *sha)


def test_runs_of_random_texts():
    rng = random.Random(4)
    for least, exponent in [(6, 4), (2, 2), (6, 2), (9, 3)] * 60:
        texts = []
        for _ in range(rng.randint(1, 5)):
            kinds, n = rng.choice([1, 2, 3, 9]), rng.randint(0, 70)
            words = [rng.randrange(kinds) for _ in range(n)]
            if n and rng.random() < 0.6:
                a, p = rng.randrange(n), rng.randint(1, 7)
                words = [w if i < a else words[a + (i - a) % min(p, n - a)] for i, w in enumerate(words)] + words[: rng.randint(0, 5)]
            texts.append(words)
        bounds = np.append(0, np.cumsum([len(t) for t in texts]))
        got = find_runs(np.array(sum(texts, []), dtype=np.int64), bounds, least, exponent)
        want = [(s + b, size, q) for b, t in zip(bounds, texts) for s, size, q in brute_runs(t, least, exponent)]
        assert list(zip(*(x.tolist() for x in got))) == want


@pytest.mark.parametrize("words, want", [
    (np.zeros(400_000, dtype=np.int64), (0, 400_000, 1)),
    (np.arange(400_000) % 2, (0, 400_000, 2)),
    (np.arange(400_000) % 50_021, (0, 400_000, 50_021)),
])
def test_very_long_texts(words, want):
    start, length, period = find_runs(words, np.array([0, len(words)]), 6, 4)
    assert list(zip(start.tolist(), length.tolist(), period.tolist())) == [want]


def test_query_against_brute_force(spark, documents, tmp_path):
    planted = [(10_000 + i, " ".join(f"w{j % (3 + i % 9)}" for j in range(i))) for i in range(60)]
    texts = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect() if len(r["text"] or "") < 8000]
    rows = texts + planted + [(None, "a b " * 9), (None, None), (1, None), (2, ""), (3, " \t\x0b "), (4, "x x " * 30), (4, "x x " * 30), (5, "A a " * 6)]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS runs", "2 AS collapsed", "'x' AS longest").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[-1])
    assert sorted(got, key=key) == sorted((brute_row(*r) for r in rows), key=key)
    assert sum(r[1] for r in got) > 40


def test_operator_keeps_runs_and_texts(spark):
    df = spark.createDataFrame([("p", "so " * 7 + "it goes"), ("q", "nothing here")], "name string, body string")
    got = {r["doc_id"]: r for r in periodic_runs.periodic_runs(df, "name", "body").collect()}
    assert [tuple(x) for x in got["p"]["runs"]] == [(0, 7, 1)] and got["p"]["collapsed"] == "so it goes"
    assert got["q"]["runs"] == [] and got["q"]["collapsed"] == "nothing here"
    assert periodic_runs.periodic_runs(df.limit(0), "name", "body").collect() == []
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(df, "name", "body", exponent=1)


def test_planted_repeats_leave_other_rows(spark):
    df = spark.createDataFrame([(7, "a  b c"), (10, None), (None, "x  y"), (20, " ")], "h long, text string")
    got = [r["text"] for r in periodic_runs.with_planted_repeats(df, F.col("h")).collect()]
    assert got == ["a  b c", None, "x  y", ""]
