"""Language identification and context-tree scores."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quarry.llm import context_tree, segment_lid
from quarry.llm.common import text_slices, word_hashes, word_spans
from quarry.llm.segment_lid import Fit, Lattice


def _arrow(texts):
    import pyarrow as pa

    return pa.array(texts, pa.string())


def test_vectorised_words_equal_a_regular_expression():
    texts = ["One two", None, "", " \t ", "x", "été\x0bÀ b", "same SAME", "a\nb" * 50, "日本 x", "end "]
    for limit in (1, 8, 1 << 20):
        got = []
        for _, _, data, offsets in text_slices(_arrow(texts), limit):
            starts, ends, first = word_spans(data, offsets)
            raw = data.tobytes()
            words = [raw[a:b].decode() for a, b in zip(starts, ends)]
            got += [words[a:b] for a, b in zip(first, first[1:])]
        assert got == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    _, _, data, offsets = next(text_slices(_arrow(["Same sAME other same É é"])))
    starts, ends, _ = word_spans(data, offsets)
    h = word_hashes(data, starts, ends).tolist()
    assert h[0] == h[1] == h[3] and len(set(h)) == 4


@pytest.fixture(scope="module")
def vocab():
    return segment_lid.vocabulary(segment_lid.default_path())


def _pieces(vocab):
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=segment_lid.default_path())
    names = [m.id_to_piece(i) for i in range(m.get_piece_size()) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i))]
    texts = [n.encode() for n in names if n == n.lower() and "▁" not in n[1:] and not any(c.isspace() for c in n)]
    out = {}
    for i, t in enumerate(texts):
        out.setdefault(t, []).append(i)
    for b in range(256):
        out.setdefault(bytes([b]), []).append(vocab.first_byte + b)
    return out


def test_forward_sums_all_segmentations(vocab):
    theta = np.random.default_rng(0).random((vocab.size, 2))
    theta /= theta.sum(axis=0)
    pieces = _pieces(vocab)

    def total(s, at=0):
        if at == len(s):
            return np.ones(2)
        return sum((theta[p] * total(s, at + n) for n in range(1, len(s) - at + 1) for p in pieces.get(s[at : at + n], ())), np.zeros(2))

    words = [b"the", "été".encode(), b"x", b"other", "日".encode()]
    want = np.log([total("▁".encode() + w) for w in words])
    assert np.abs(Lattice(vocab, words).log_probability(theta) - want).max() < 1e-9
    assert np.abs(np.array([segment_lid.long_word(vocab, w, theta) for w in words]) - want).max() < 1e-9


def test_fitting_raises_the_likelihood(vocab):
    words, counts = [b"the", b"thing", b"there", b"these"], np.array([[9.0], [3.0], [2.0], [1.0]])
    scores = [
        float((Lattice(vocab, words).log_probability(segment_lid.fit(vocab, words, counts, Fit(rounds=k, prior=1e-9))) * counts).sum()) for k in (1, 2, 4, 8)
    ]
    assert scores == sorted(scores)


def test_held_out_accuracy(documents):
    got = {r["doc_id"]: r for r in segment_lid.identify_documents(documents).collect()}
    truth = {r["doc_id"]: r["lang"] for r in documents.collect()}
    held = [d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2]
    assert {d for d, r in got.items() if r["held_out"]} == set(held)
    assert np.mean([got[d]["lang_pred"] == truth[d] for d in held]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_odd_texts(odd_documents, documents):
    rows = segment_lid.identify_documents(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add((r["lang_pred"], r["score"]))
    assert all(by[d] == {("und", 0.0)} for d in (3, 4, 5, 7))
    assert len(by[1]) == 1 and {p for p, _ in by[8]} <= {"en", "fr"}
    kept = segment_lid.known_language(odd_documents)
    assert kept.columns == odd_documents.columns and {r["doc_id"] for r in kept.collect()}.isdisjoint({3, 4, 5, 7})
    nothing = odd_documents.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {(r["lang_pred"], r["score"]) for r in segment_lid.identify_documents(nothing).collect()} == {("und", 0.0)}
    assert segment_lid.identify_documents(documents.limit(0)).collect() == []


# ---- context trees ------------------------------------------------------------------

def _stream(texts, depth):
    _, _, data, offsets = next(text_slices(_arrow(texts)))
    return context_tree.streams(data, *word_spans(data, offsets), depth)


def test_streams():
    s, bounds = _stream(["A b", None, "  É ", "x\ny"], 3)
    assert [s[a + 3 : b].tobytes().decode() for a, b in zip(bounds, bounds[1:])] == ["a b\n", "\n", "É\n", "x y\n"]
    assert all((s[a : a + 3] == 10).all() for a in bounds[:-1])


def _tree(texts, depth, least):
    s, b = _stream(texts, depth)
    keys, n = np.unique(context_tree.gram_codes(s, b, depth), return_counts=True)
    out = []
    for d in range(depth + 1):
        grams = Counter()
        for k, c in zip(keys.tolist(), n.tolist()):
            grams[(k >> (8 * (depth - d) + 8)) if d else 0, k & 255] += c
        held = Counter()
        for (c, _), m in grams.items():
            held[c] += m
        out += [(d, c, x, m) for (c, x), m in grams.items() if held[c] >= least]
    return context_tree.weigh(*(np.array(c, dtype=np.int64) for c in zip(*out)), depth), s, b


def test_mixtures_are_probabilities():
    tree, _, _ = _tree(["abracadabra alakazam abra", "cadabra zam"], 3, 2)
    assert np.abs((10.0 ** tree.log10.astype(float)).sum(axis=1) - 1).max() < 1e-5


def _log_kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - 2 * math.lgamma(0.5)


def test_weights_follow_the_recursion():
    """The mixture of one binary decision, by the textbook recursion over explicit contexts."""
    text, depth = "abaabbabab" * 6, 2
    tree, s, b = _tree([text], depth, 1)
    bits = [(bytes(s[max(0, i - depth) : i][::-1].tolist()), int(s[i])) for i in range(int(b[0]) + depth, len(s))]

    def counts(context, prefix, level):
        hits = [x for c, x in bits if c[: len(context)] == context and x >> (8 - level) == prefix] if level else [x for c, x in bits if c[: len(context)] == context]
        ones = sum(x >> (7 - level) & 1 for x in hits)
        return len(hits) - ones, ones

    def weighted(context, prefix, level):
        z, o = counts(context, prefix, level)
        if len(context) == depth:
            return _log_kt(z, o)
        kids = {c[: len(context) + 1] for c, _ in bits if c[: len(context)] == context}
        return np.logaddexp(math.log(0.5) + _log_kt(z, o), math.log(0.5) + sum(weighted(k, prefix, level) for k in kids))

    def predict(context, prefix, level, at=0):
        z, o = counts(context[:at], prefix, level)
        own = (o + 0.5) / (z + o + 1)
        if at == depth:
            return own
        w = math.exp(math.log(0.5) + _log_kt(z, o) - weighted(context[:at], prefix, level))
        return w * own + (1 - w) * predict(context, prefix, level, at + 1)

    context = b"ab"  # latest first
    node = tree.child[tree.child[0, context[0]], context[1]]
    for x in (ord("a"), ord("b")):
        want = 0.0
        for level in range(8):
            p = predict(context, x >> (8 - level), level)
            want += math.log10(p if x >> (7 - level) & 1 else 1 - p)
        assert abs(tree.log10[node, x] - want) < 1e-4


def test_scores_on_the_table(documents):
    got = {r["doc_id"]: r for r in context_tree.score(documents, segment_lid.held_out(folds=10, fold=0)).collect()}
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    tokens = {r["doc_id"]: re.findall(r"[^\x20\x09-\x0D]+", r["text"].translate(low)) + ["\0end"] for r in documents.collect()}
    train = Counter(w for d, ws in tokens.items() if zlib.crc32(str(d).encode()) % 10 for w in ws)
    n, v = sum(train.values()), len(train)
    for d, ws in tokens.items():
        want = sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        r = got[d]
        assert r["train_tokens"] == n and r["n_tokens"] == len(ws) and r["n_known"] == sum(train[w] > 0 for w in ws)
        assert math.isclose(r["base_score"], want, rel_tol=1e-9) and r["score"] < 0
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 10 == 0)
    held = [r for r in got.values() if r["held_out"]]
    assert 1.5 < np.mean([r["bits_per_byte"] for r in held]) < 3.0


def test_rare_words_are_joined(documents):
    """The word split between tasks and the join changes no score."""
    held = segment_lid.held_out(folds=10, fold=0)
    few = documents.where("doc_id < 60")
    a, b = ({r["doc_id"]: r for r in context_tree.score(few, held, context_tree.Shape(word_share=s)).collect()} for s in (1e-9, 0.01))
    for d in a:
        assert a[d]["n_known"] == b[d]["n_known"] and math.isclose(a[d]["base_score"], b[d]["base_score"], rel_tol=1e-12)
        assert a[d]["score"] == b[d]["score"]


def test_odd_scores(odd_documents):
    rows = context_tree.score(odd_documents, segment_lid.held_out(folds=10, fold=0)).collect()
    assert len(rows) == odd_documents.count() and all(r["score"] < 0 and r["n_tokens"] >= 1 for r in rows)
    assert all(r["n_tokens"] == 1 for r in rows if r["doc_id"] in (3, 4, 5))
    from pyspark.sql import functions as F

    blind = context_tree.score(odd_documents, F.lit(True)).collect()
    assert {r["train_tokens"] for r in blind} == {0}
    assert all(abs(r["bits_per_byte"] - 8) < 1e-4 and r["n_known"] == 0 for r in blind)
    assert context_tree.score(odd_documents.limit(0), F.lit(False)).collect() == []


def test_rare_contexts_are_kept(spark):
    """Every context counts, however small its share; the pairs split between tasks and the join change no score."""
    from pyspark.sql import functions as F

    rows = [(k, "the old river bank stood near a quiet town " * 300) for k in range(40)] + [(k, f"zyx{k} qwertz uiop") for k in range(40, 44)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = F.col("doc_id") >= 43
    tree, _, _ = _tree([t for d, t in rows if d < 43], 5, 0)
    want = dict(zip((d for d, _ in rows), context_tree.code_lengths(tree, *_stream([t for _, t in rows], 5))))
    a, b, c = (
        {r["doc_id"]: r["score"] for r in context_tree.score(docs, held, context_tree.Shape(heart=h)).collect()} for h in (500_000, 40, 0)
    )
    assert a == b == c
    assert all(math.isclose(a[d], want[d], rel_tol=1e-4) for d in want)


def test_streams_and_grams_of_odd_texts():
    """Streams and grams by the byte, whatever the white space between words and wherever texts are cut."""
    texts = ["A b", None, "", "  É ", "x \t\ny", " \t", "end ", "\0" * 9, " lead", "q", "a" * 30]
    for limit in (1, 7, 1 << 20):
        for depth in (1, 5, 6):
            got = []
            for _, _, data, offsets in text_slices(_arrow(texts), limit):
                s, bounds = context_tree.streams(data, *word_spans(data, offsets), depth)
                grams = context_tree.gram_codes(s, bounds, depth).tolist()
                got += [s[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
                want = [int.from_bytes(s[i - depth : i + 1].tobytes()[:-1], "little") << 8 | int(s[i]) for a, b in zip(bounds, bounds[1:]) for i in range(a + depth, b)]
                assert grams == want
            low = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
            assert got == [b"\n" * depth + b" ".join(w).lower() + b"\n" for w in low]


def test_places_find_what_a_dictionary_finds():
    rng = np.random.default_rng(5)
    ones = np.uint64((1 << 64) - 1)
    for known in (np.zeros(0, np.uint64), np.zeros(1, np.uint64), np.append(rng.permutation(3000).astype(np.uint64) << np.uint64(40), ones)):
        places = context_tree.Places(known)
        if len(known) > 1:  # many keys with one slot of their own
            own = places._own(np.arange(400_000, dtype=np.uint64))
            known = np.unique(np.append(known, np.flatnonzero(own < 3).astype(np.uint64)))
            places = context_tree.Places(known)
        want = {k: i for i, k in enumerate(known.tolist())}
        asked = np.concatenate([known, rng.integers(0, 1 << 50, 5000).astype(np.uint64), np.arange(5000, dtype=np.uint64), np.array([0, ones], np.uint64)])
        assert places.find(asked).tolist() == [want.get(k, -1) for k in asked.tolist()]
        assert places.find(asked[:0]).tolist() == []


def test_pairs_are_found_without_a_binary_search():
    """Finding a slice's pairs among as many as tasks know by heart takes less than half of a binary search's CPU time."""
    import time

    rng = np.random.default_rng(6)
    known = np.unique(rng.integers(0, 1 << 48, context_tree.Shape().heart).astype(np.uint64))
    asked = known[rng.integers(0, len(known), 1 << 20)]
    places = context_tree.Places(known)

    def least(run):
        took = []
        for _ in range(3):
            begun = time.process_time()
            found = run(known, asked) if run is np.searchsorted else run(asked)
            took.append(time.process_time() - begun)
            assert (known[found] == asked).all()
        return min(took)

    assert least(places.find) < least(np.searchsorted) / 2


def test_a_tally_merges_within_few_bytes_a_key(monkeypatch):
    import tracemalloc

    monkeypatch.setattr(context_tree, "HELD_KEYS", 60_000)
    rng, tally, want = np.random.default_rng(7), context_tree.Tally(), Counter()
    tracemalloc.start()
    try:
        for _ in range(12):
            keys = rng.integers(0, 50_000, 30_000).astype(np.uint64)
            assert not tally.add(keys)
        top = tracemalloc.get_traced_memory()[1]
        got = dict(zip(*(x.tolist() for x in tally.take())))
    finally:
        tracemalloc.stop()
    rng = np.random.default_rng(7)
    for _ in range(12):
        want.update(rng.integers(0, 50_000, 30_000).tolist())
    assert got == want and [len(x) for x in tally.take()] == [0, 0]
    assert top < 52 * 120_000  # at most twice as many keys are held


# ---- the pipeline ------------------------------------------------------------------

def test_pipeline_stages(spark, documents):
    import corpus_pipeline as p
    from quarry.llm.common import stored

    docs, seen = documents, []
    for name, stage in p.STAGES:
        out = stored(stage(spark, docs, "/root/testdata/sf0.001"), "test-stage")
        seen.append((name, docs, out))
        if name != p.STAGES[-1][0]:
            assert out.columns == documents.columns
        docs = out
    names = [n for n, _, _ in seen]
    assert names == ["language", "lines", "near_duplicates", "decontamination", "packing"]
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for _, d, _ in seen] + [{r["doc_id"] for r in docs.select("doc_id").collect()}]
    assert ids[1] == ids[2] and ids[3] < ids[2] and ids[4] < ids[3] and ids[5] == ids[4]
    assert all(r["n_chars"] == len(r["text"]) for r in seen[1][2].collect())
    assert {tuple(r) for r in p.run(spark, "/root/testdata/sf0.001").drop("sequence_id", "offset").collect()} == {
        tuple(r) for r in docs.drop("sequence_id", "offset").collect()}


def test_pipeline_on_odd_documents(spark, odd_documents, tmp_path):
    import corpus_pipeline as p

    docs = odd_documents.withColumn("n_chars", odd_documents["n_chars"].cast("long"))
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    for table in (docs, docs.limit(0)):
        step = table
        for name, stage in p.STAGES[:-1]:
            step = stage(spark, step, str(tmp_path))
            assert step.columns == docs.columns
        assert p.STAGES[-1][1](spark, step, str(tmp_path)).count() >= 0


def test_language_goes_through_python_in_bounded_batches(spark, monkeypatch):
    import pyarrow as pa

    import corpus_pipeline as p

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64())], ["n"])

    monkeypatch.setattr(p.segment_lid, "known_language", lambda docs: docs.mapInArrow(sizes, "n long"))
    docs = spark.range(4_000, numPartitions=1).selectExpr("id AS doc_id", "repeat('some text ', 800) AS text")
    got = [r["n"] for r in p.language(spark, docs, "").collect()]
    assert sum(got) > 30 << 20 and max(got) < 10 << 20


def test_a_stage_that_stored_its_rows_is_not_stored_again(spark, monkeypatch, documents):
    import corpus_pipeline as p

    names, keep = [], p.stored
    monkeypatch.setattr(p, "stored", lambda df, name: names.append(name) or keep(df, name))
    monkeypatch.setattr(p, "STAGES", p.STAGES[:2])
    rows = p.run(spark, "/root/testdata/sf0.001")
    assert names == ["language", "stage-lines"] and 0 < rows.count() <= documents.count()


def test_scoring_words_takes_bounded_memory(vocab):
    import tracemalloc

    rng = random.Random(5)
    words = [bytes(rng.choices(b"abcdefghilmnorstu", k=rng.randint(3, 12))) for _ in range(20_000)]
    theta = np.random.default_rng(0).random((vocab.size, 4))
    scores = segment_lid.WordScores(segment_lid.Model(("a", "b", "c", "d"), theta / theta.sum(axis=0), segment_lid.default_path()))
    tracemalloc.start()
    try:
        got = scores._new(words)
        assert tracemalloc.get_traced_memory()[1] < 25e6  # 57e6 in one pass
    finally:
        tracemalloc.stop()
    assert np.array_equal(got, Lattice(vocab, words).log_probability(scores.model.theta))


def test_scripts_without_spaces_are_learnt(spark):
    """Whole paragraphs are one word there; they train and tell the languages apart."""
    rng = random.Random(11)
    scripts = {"zh": "的一是在不了有和人这中大为上个国我以要他时来用们生到作地于出就分对成会可主发年动同工也能下过子说产种面而方后多定行学法所民得经", "ja": "のにはをたがでてとしれさあるいもするなんかっまりらこよきじおえみけつわうどちせそふめほくげ日本語文章東京時間人間新聞言葉",
               "th": "กขคงจชซญดตถทธนบปผพฟมยรลวศสหอะาิีึุูเแโใไ่้็์ฉฝฮณฐ", "en": ""}
    words = "the of and to in is was he for it with as his on be at by had not are but from or have".split()
    rows = []
    for lang, chars in scripts.items():
        for _ in range(90):
            text = " ".join(rng.choice(words) for _ in range(40)) if lang == "en" else "".join(rng.choice(chars) for _ in range(rng.randint(60, 200)))
            rows.append((len(rows), text, lang))
    got = segment_lid.identify_documents(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    want = {r[0]: r[2] for r in rows}
    asked = [r for r in got if r["held_out"]]
    assert len(asked) > 60 and {want[r["doc_id"]] for r in asked} == set(scripts)
    for lang in scripts:
        mine = [r for r in asked if want[r["doc_id"]] == lang]
        assert sum(r["lang_pred"] == lang for r in mine) >= 0.95 * len(mine), lang


def test_long_words_are_cut_between_characters():
    cuts, counts = segment_lid.cut_words(["日本語".encode() * 20, b"short", b"x" * 100], np.arange(6.0).reshape(3, 2))
    assert b"".join(cuts) == "日本語".encode() * 20 + b"short" + b"x" * 100 and all(len(c) <= segment_lid.SHORT for c in cuts)
    assert [c.decode() for c in cuts] and counts[:, 0].tolist() == [0.0] * 4 + [2.0] + [4.0] * 3
