"""Packing operators: exact round trips, capacities, and brute-force best fit."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import best_fit, id_matrix, tokens
from quarry.llm.best_fit import Capacity


def test_rank_file_gives_the_tokenizers_ids(documents, ranks):
    texts = [r["text"] for r in documents.select("text").collect()][:120]
    texts += ["", "a  b\n\n c\t", "été — 日本語  x", "it's we'll I'd", "<|endoftext|>", "  lead", "trail  ", "x1y2 3,4"]
    slow = tokens.default_path("byte_bpe_50k.json")
    for t in texts:
        assert tokens.encode(ranks, t).tolist() == tokens.encode(slow, t).tolist()


def test_added_tokens_are_those_of_the_unmodified_tokenizer(ranks):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.default_path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"a{end}b", end, end * 3, f" x  {end} y\n{end}", f"<|{end}|>", "<|endoftext", f"é{end}日本 {end[:-1]} z", ""]
    for t in texts:
        assert tokens.encode(ranks, t).tolist() == [*plain.encode(t, add_special_tokens=False).ids, tokens.END_ID]


@pytest.mark.parametrize("n,want", [(1, [(0, 1)]), (1024, [(0, 1024)]), (1025, [(0, 1), (1, 1024)]), (2500, [(0, 452), (452, 1024), (1476, 1024)])])
def test_only_the_first_piece_is_short(n, want):
    assert tokens.cuts(n, 1024) == want


def _expand(runs):
    for length, r0, r1, bin0, per, off in runs:
        for r in range(r0, r1):
            yield length, r, bin0 + (r - r0) // per, off + (r - r0) % per * length


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120), st.sampled_from(["norm", "dot"]), st.integers(1, 9), st.integers(4096, 9000))
def test_plan_places_every_piece_within_every_capacity(lengths, measure, most, cost):
    cap = Capacity(64, most, cost, (1.0, 0.5, 0.5), measure)
    histogram = {n: lengths.count(n) for n in set(lengths)}
    bins = defaultdict(list)
    seen = defaultdict(set)
    for length, rank, b, off in _expand(best_fit.plan(histogram.items(), cap)):
        bins[b].append((off, length))
        seen[length].add(rank)
    assert {n: len(s) for n, s in seen.items()} == histogram
    for pieces in bins.values():
        pieces.sort()
        at = 0
        for off, length in pieces:
            assert off == at
            at += length
        assert at <= 64 and len(pieces) <= most and sum(n * n for _, n in pieces) <= cost


def _sequential(lengths, cap):
    """Best-fit decreasing one piece at a time."""
    open_ = []
    for n in sorted(lengths, reverse=True):
        need = cap.vector(n)
        fits = [i for i, r in enumerate(open_) if (r >= need).all()]
        if fits:
            s = cap.scores(np.array([open_[i] for i in fits]), need)
            i = fits[int(np.argmin(s))]
        else:
            open_.append(cap.whole.copy())
            i = len(open_) - 1
        open_[i] = open_[i] - need
    return len(open_)


def test_plan_needs_as_few_sequences_as_one_by_one_best_fit():
    rng = random.Random(4)
    for k in range(25):
        lengths = [rng.choice([rng.randint(1, 64), rng.randint(1, 12), 33]) for _ in range(200)]
        cap = Capacity(64, 64, 64 * 64, (1.0, 1e-3, 1e-3), "norm")
        used = {b for _, _, b, _ in _expand(best_fit.plan({n: lengths.count(n) for n in set(lengths)}.items(), cap))}
        assert len(used) <= _sequential(lengths, cap) + 1
        assert len(used) >= -(-sum(lengths) // 64)


def _check_pack(rows, texts, path, size):
    want = defaultdict(list)
    for d, t in texts:
        ids = tokens.encode(path, t)
        want[d].append([(k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(tokens.cuts(len(ids), size))])
    got = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {d: sorted(x) for d, x in got.items()} == {d: sorted(p for w in ws for p in w) for d, ws in want.items()}
    for parts in sequences.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= size
    return len(sequences), sum(n for p in sequences.values() for _, n in p)


def test_documents_are_packed_whole(documents, ranks):
    rows = best_fit.pack_documents(documents, ranks).collect()
    texts = [(r["doc_id"], r["text"]) for r in documents.collect()]
    n, total = _check_pack(rows, texts, ranks, 1024)
    assert n <= -(-total // 1024) * 1.02 + 1


def test_odd_documents_are_packed(odd_documents, ranks):
    rows = best_fit.pack_documents(odd_documents, ranks, Capacity(64, 4, 64 * 64)).collect()
    _check_pack(rows, [(r["doc_id"], r["text"]) for r in odd_documents.collect()], ranks, 64)
    assert best_fit.pack_documents(odd_documents.limit(0), ranks).collect() == []


def test_pieces_can_carry_their_ids(documents, ranks):
    few = documents.where("doc_id < 20")
    got = defaultdict(dict)
    for r in best_fit.pieces(few, ranks, 128, with_ids=True).collect():
        got[r["doc_id"]][r["piece"]] = bytes(r["ids"])
    for r in few.collect():
        assert b"".join(v for _, v in sorted(got[r["doc_id"]].items())) == tokens.encode(ranks, r["text"]).tobytes()


def test_segment_tree_takes_the_tightest_row():
    rng = random.Random(1)
    tree, open_ = id_matrix.CapacityTree(100), {}
    for row in range(300):
        r = rng.randint(0, 100)
        tree.add(r, row)
        open_[row] = r
    for _ in range(250):
        need = rng.randint(1, 100)
        fits = [v for v in open_.values() if v >= need]
        found = tree.take(need)
        assert (found is None) == (not fits)
        if found:
            assert found[0] == min(fits) and open_.pop(found[1]) == found[0]


@pytest.mark.parametrize("block", [200, 1 << 21])
def test_rows_give_every_id_back(odd_documents, documents, ranks, block):
    for docs in (odd_documents.select("doc_id", "text", "n"), documents.select("doc_id", "text")):
        back = defaultdict(list)
        for r in id_matrix.pack_rows(docs, ranks, 256, block_tokens=block).collect():
            ids = np.frombuffer(r["ids"], dtype="<u4")
            assert len(ids) == 256 and r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"]
            assert (ids[r["n_tokens"] :] == id_matrix.PAD_ID).all()
            assert r["position_resets"] == r["cu_seqlens"][:-1] + ([r["n_tokens"]] if r["n_tokens"] < 256 else [])
            for d, k, s, a, b in zip(r["doc_ids"], r["pieces"], r["starts"], r["cu_seqlens"], r["cu_seqlens"][1:]):
                back[d].append((k, s, ids[a:b].tolist()))
        want = defaultdict(list)
        for r in docs.collect():
            ids = tokens.encode(ranks, r["text"]).tolist()
            want[r["doc_id"]] += [(k, s, ids[s : s + n]) for k, (s, n) in enumerate(tokens.cuts(len(ids), 256))]
        assert {d: sorted(x) for d, x in back.items()} == {d: sorted(x) for d, x in want.items()}
    assert id_matrix.pack_rows(documents.limit(0), ranks).collect() == []


@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 2_000_000, "x" * 2_000_000, "日本" * 400_000 + " a" * 300_000 + "\t" * 400_000, "a" * 19_999 + " " * 19_999])
def test_long_runs_are_encoded(ranks, text):
    from tokenizers import Tokenizer

    named = Tokenizer.from_file(ranks.replace(".tiktoken", ".json"))
    assert tokens.encode(ranks, text).tolist() == [*named.encode(text, add_special_tokens=False).ids, 2]


def test_long_runs_are_packed(spark, ranks):
    df = spark.createDataFrame([(1, " " * 1_200_000), (2, "\n" * 600_000 + "end"), (3, "z" * 700_000)], "doc_id long, text string")
    for pack in (best_fit.pack_documents, id_matrix.pack_rows):
        assert pack(df, ranks).count() > 100
