"""Importance resampling against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from quarry.llm.queries import QUERIES
from quarry.llm.target_sampling import Grams, GramTable, bucket_counts, crc32s, grams, resample, xxhash64

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def brute(docs, target):
    s = Counter(bucket(f) for _, t in docs for f in features(t)[1])
    t = Counter(bucket(f) for x in target for f in features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in range(10_000)}
    out = []
    for doc_id, text in docs:
        words, found = features(text)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[: 25 * len(able) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def byte_ranges(seed=2):
    rng = random.Random(seed)
    data = np.frombuffer(bytes(rng.choice(b"ab\xc3") for _ in range(3000)) + bytes(8), dtype=np.uint8)
    starts = np.array([rng.randrange(2800) for _ in range(4000)])
    return data, starts, np.array([rng.choice([0, 1, 2, 3, 4, 5, 7, 8, 9, 12, 15, 16, 20, 24, 31, 32, 33, 100]) for _ in range(4000)])


def test_hashes_are_those_of_the_libraries():
    data, starts, sizes = byte_ranges()
    texts = [data[s : s + n].tobytes() for s, n in zip(starts, sizes)]
    assert xxhash64(data, starts, sizes).tolist() == [xxhash.xxh64_intdigest(t) for t in texts]
    assert crc32s(data, starts, sizes).tolist() == [zlib.crc32(t) for t in texts]


@pytest.mark.parametrize("clash", [False, True])
def test_table_keeps_features_apart(monkeypatch, clash):
    if clash:  # all keys equal: only the bytes tell features apart
        monkeypatch.setattr("quarry.llm.target_sampling.xxhash64", lambda data, starts, sizes: np.zeros(len(starts), dtype=np.uint64))
    data, starts, sizes = (x[:400] if i else x for i, x in enumerate(byte_ranges()))
    table = GramTable(data, starts, sizes, 97)
    texts = [data[s : s + n].tobytes() for s, n in zip(starts, sizes)]
    slots = {}
    for t, slot in zip(texts, table.slot.tolist()):
        slots.setdefault(t, set()).add(slot)
    assert all(len(s) == 1 for s in slots.values()) and len(set.union(*slots.values())) == len(slots)
    times = Counter(texts)
    for t, (slot,) in slots.items():
        assert table.count[slot] == times[t] and table.bucket[slot] == zlib.crc32(t) % 97


def test_grams_of_texts():
    texts = ["Über-Alles 7x!", "", "one", "A b  C"]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), dtype=np.uint8), np.append(0, np.cumsum([len(r) for r in raw]))
    packed, at, sizes, bounds, words = grams(data, offsets, 2)
    got = [[packed[s : s + n].tobytes().decode() for s, n in zip(at[a:b], sizes[a:b])] for a, b in zip(bounds, bounds[1:])]
    assert [sorted(g) for g in got] == [sorted(features(t)[1]) for t in texts]
    assert words.tolist() == [3, 0, 1, 3]


def corpus():
    rng = random.Random(6)
    plain, topic = [f"w{i}" for i in range(300)], ["cell", "Enzyme", "protein", "été", "日本", "x" * 40]
    docs = [(i, " ".join(rng.choice(topic if rng.random() < i / 400 else plain) for _ in range(rng.randint(0, 60)))) for i in range(200)]
    docs += [(7, docs[9][1]), (7, docs[9][1]), (None, docs[30][1]), (None, None), (900, None), (901, ""), (902, " -- "), (903, "word " * 20_000)]
    return docs, [" ".join(rng.choice(topic) for _ in range(30)) for _ in range(20)] + [None]


def test_query_against_brute_force(spark, tmp_path):
    docs, target = corpus()
    spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS rank", "2 AS place", "3 AS part", "4 AS n", "5 AS able").repartition(6).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = [tuple(r) for r in QUERIES["op13_target_sampling"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == brute(docs, target)
    drawn = [r for r in got if r[4] is not None]
    assert sorted(r[4] for r in drawn) == list(range(1, len(drawn) + 1))


def test_target_documents_weigh_more(spark):
    docs, target = corpus()
    df, goal = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(t,) for t in target], "text string")
    weight = {r["doc_id"]: r["weight"] for r in resample(df, goal).where("n_features > 20 AND doc_id < 200").collect()}
    low = [w for i, w in weight.items() if i < 60]
    high = [w for i, w in weight.items() if i >= 140]
    assert sum(high) / len(high) > sum(low) / len(low) + 300


def test_empty_tables_and_other_shapes(spark):
    docs, target = corpus()
    df, goal = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(t,) for t in target], "text string")
    assert resample(df.limit(0), goal).collect() == []
    assert resample(df, goal.limit(0), percent=0).where("rank IS NOT NULL").count() == 0
    assert bucket_counts(df.limit(0)).collect() == []
    some = resample(df, goal, percent=100, least_words=1, shape=Grams(3, 50))
    assert some.where("rank IS NULL").count() == sum(not WORD.search(t or "") for _, t in docs)
    with pytest.raises(ValueError):
        resample(df, goal, percent=101)
