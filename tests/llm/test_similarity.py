"""Near duplicates of vectors and documents against all pairs."""

from __future__ import annotations

import random
import re
import tracemalloc

import numpy as np
import pytest

from quarry.llm import lattice, shingle_tree
from quarry.llm.components import components
from quarry.llm.shingle_tree import RTree, Threshold


def _roots(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 140)] + [(7, k) for k in range(200, 260)] + [(5, 5)]
    links += [(rng.randint(300, 420), rng.randint(300, 420)) for _ in range(70)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = _roots({x for l in links if l[0] != l[1] for x in l}, [l for l in links if l[0] != l[1]])
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# ---- vectors ------------------------------------------------------------------

def _vectors(seed=5, dim=64):
    rng = np.random.default_rng(seed)
    rows, at = [], 0
    for label in (0, 1, 2):
        for _ in range(60):
            x = rng.normal(size=dim)
            x /= np.linalg.norm(x)
            for _ in range(rng.integers(1, 5)):
                z = rng.normal(size=dim)
                z -= (z @ x) * x
                z /= np.linalg.norm(z)
                c = rng.uniform(0.9, 1.0)
                rows.append((at, (c * x + np.sqrt(1 - c * c) * z).astype(np.float32).tolist(), label))
                at += 1
    rows += [(at + k, rows[3][1], rows[3][2]) for k in range(5)]  # exact copies
    rows += [(at + 10, [v * 3 for v in rows[3][1]], rows[3][2]), (at + 11, rows[3][1], 99), (at + 12, rows[3][1], None)]
    rows += [(at + 20, None, 0), (at + 21, [0.0] * dim, 0), (at + 22, [float("nan")] * dim, 0), (at + 23, [float("inf")] + [1.0] * (dim - 1), 0)]
    rows += [(at + 24, [None] + [1.0] * (dim - 1), 0), (at + 25, [], 0), (at + 26, [1.0, 2.0], 0), (at + 27, [1.0, 2.0], 0), (None, rows[3][1], rows[3][2])]
    return rows


def _brute(rows):
    def sound(i, v, label):
        return i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [(i, np.array(v, dtype=np.float32).astype(float), g) for i, v, g in rows if sound(i, v, g)]
    links = []
    for a, (i, x, g) in enumerate(good):
        for j, y, h in good[:a]:
            if g == h and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                links.append((i, j))
    root = _roots([r[0] for r in rows if r[0] is not None], links)
    n = {i: sum(i in l for l in links) for i in root}
    return links, root, n


@pytest.mark.parametrize("chunk", [1024, 3])
def test_vectors_link_as_all_pairs_do(spark, chunk):
    rows = _vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS cell", "2 AS n", "3 AS rep")
    got = lattice.near_vectors(df, how=lattice.Hashing(chunk=chunk)).collect()
    links, root, n = _brute(rows)
    assert len(got) == len(rows)
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got if r["vec_id"] is not None}
    assert all(found[i][0] <= n[i] for i in n)
    assert sum(f[0] for f in found.values()) >= 0.98 * 2 * len(links)
    clear = [i for i in n if found[i][0] == n[i]]
    assert len(clear) > 0.95 * len(n) and all(found[i][2] == (found[i][1] == i) for i in n)
    assert sum(found[i][1] == root[i] for i in n) >= 0.97 * len(n)
    assert [tuple(r) for r in got if r["vec_id"] is None] == [(None, 0, None, True)]
    assert lattice.near_vectors(df.limit(0)).collect() == []


def test_pairs_at_the_threshold_meet():
    """Recall over pairs at cosine 0.93 exactly, the hardest that count."""
    rng = np.random.default_rng(0)
    x, z = rng.normal(size=(2, 3000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z -= (z * x).sum(axis=1)[:, None] * x
    y = 0.93 * x + np.sqrt(1 - 0.93**2) * z / np.linalg.norm(z, axis=1)[:, None]
    a, b = (lattice.cells(v, np.zeros(3000, np.int64), lattice.Hashing()) for v in (x, y))
    met = (a[:, :, :1] == b).any(axis=(1, 2)) | (b[:, :, :1] == a).any(axis=(1, 2))
    assert met.mean() >= 0.97


def test_closest_lattice_points():
    rng = np.random.default_rng(2)
    y = rng.normal(size=(300, 8)) * 2
    p = lattice.closest_point(y)
    twice = np.round(2 * p)
    assert np.allclose(2 * p, twice) and ((twice % 2).sum(axis=1) % 8 == 0).all() and (p.sum(axis=1) % 2 == 0).all()
    for k in range(300):  # no neighbour is closer
        assert ((y[k] - p[k]) ** 2).sum() <= ((y[k] - p[k] - lattice._roots()) ** 2).sum(axis=1).min() + 1e-9


# ---- documents -----------------------------------------------------------------

def _sets(rows):
    out = []
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append((d, frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    return out


def _near(rows):
    sets = _sets(rows)
    links = []
    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if i is not None and j is not None and x and y and 100 * len(x & y) >= 75 * len(x | y):
                links.append((i, j))
    return {d: len(s) for d, s in sets}, _roots({d for d, _ in sets if d is not None}, links)


def _corpus(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(55))
    rows, at = [], 0
    for n in (6, 9, 12, 20, 40, 80, 160, 300):
        for _ in range(4):
            words = [rng.choice(vocabulary) for _ in range(n)]
            for _ in range(rng.randint(1, 7)):
                copy = list(words)
                for _ in range(rng.randint(0, max(1, n // 25))):
                    copy[rng.randrange(n)] = rng.choice(vocabulary)
                text = " ".join(copy)
                rows.append((at, text + (" " + passage if rng.random() < 0.2 else "")))
                at += 3
    rows += [(1000 + k, t) for k, (_, t) in enumerate(rows[:20])]
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, "one two"), (2004, "ONE\ttwo"), (2005, "two one"), (None, rows[0][1]), (2003, "one two")]
    rows += [(3000 + k, passage + f" tail {k}") for k in range(30)]
    return rows


@pytest.mark.parametrize("limit", [500_000, 0])
def test_documents_link_as_all_pairs_do(spark, limit):
    rows = _corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS class", "2 AS n", "3 AS key")
    got = shingle_tree.near_documents(docs, broadcast_ids=limit).collect()
    sizes, root = _near(rows)
    assert len(got) == len(rows)
    for r in got:
        assert r["n_shingles"] == sizes[r["doc_id"]]
        assert r["component_id"] == (root[r["doc_id"]] if r["doc_id"] is not None else None)
    kept = shingle_tree.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in set(ids) if i is not None) == sorted(i for i in root if root[i] == i) and None in ids
    assert shingle_tree.near_documents(docs.limit(0)).collect() == []


def test_a_family_beyond_one_chunk(spark, monkeypatch):
    """Bucket chunks and R-tree units give the same components when buckets are dealt in small chunks."""
    monkeypatch.setattr(shingle_tree, "CHUNK", 4)
    rows = _corpus(7)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _, root = _near(rows)
    assert {r["doc_id"]: r["component_id"] for r in shingle_tree.near_documents(docs).collect() if r["doc_id"] is not None} == root


def test_tables_documents(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    sizes, root = _near(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in shingle_tree.near_documents(documents).collect()}
    assert got == {d: (sizes[d], root[d]) for d in root}


@pytest.mark.parametrize("seed", range(6))
def test_r_tree_loses_no_pair_within_the_bound(seed):
    rng = np.random.default_rng(seed)
    t = Threshold()
    trees, data = [], []
    for m in (int(rng.integers(1, 90)), int(rng.integers(1, 400))):
        v = rng.poisson(rng.choice([0.5, 3.0, 9.0], size=(m, 1)), size=(m, shingle_tree.GROUPS)).astype(np.int32)
        v[: m // 3] = v[0]
        n = np.maximum(v.sum(axis=1), 1)
        data.append((v, n))
        trees.append(RTree(v, n))
    a, b = trees[0].joined(trees[1], t)
    found = set(zip(a.tolist(), b.tolist()))
    (v, n), (w, m) = data
    want = {(i, j) for i in range(len(v)) for j in range(len(w)) if np.minimum(v[i], w[j]).sum() >= t.least_overlap(n[i] + m[j])}
    assert found == want and len(found) == len(a)


def test_least_overlap_is_the_threshold():
    t = Threshold()
    for a in range(1, 40):
        for b in range(1, 40):
            want = next((o for o in range(min(a, b) + 1) if 100 * o >= 75 * (a + b - o)), None)
            if want is not None:
                assert t.least_overlap(a + b) == want and want >= a - t.prefix(a) + 1


def test_one_id_may_name_several_vectors(spark):
    rows = [(1, [1.0, 0.0, 0.0], 0), (1, [0.0, 1.0, 0.0], 0), (2, [0.99, 0.01, 0.0], 0), (3, [0.01, 0.99, 0.0], 0), (3, [0.0, 0.0, 1.0], 0), (3, [0.0, 0.0, 1.0], 0)]
    got = lattice.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (3, 1, 3, True), (3, 1, 3, True)]


def test_doubles_are_compared_as_doubles(spark):
    """Cosines a hair above and below the bound, which single precision cannot tell apart."""
    rows = []
    for k in range(40):
        c = 0.93 + (1e-10 if k % 2 else -1e-10)
        axis = [0.0] * 8
        axis[k % 8] = 1.0
        other = [0.0] * 8
        other[k % 8], other[(k + 1) % 8] = c, (1 - c * c) ** 0.5
        rows += [(2 * k, axis, k), (2 * k + 1, other, k)]
    got = {r["vec_id"]: r["n_links"] for r in lattice.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert not any(got[2 * k] or got[2 * k + 1] for k in range(0, 40, 2))
    assert sum(got[2 * k] == got[2 * k + 1] == 1 for k in range(1, 40, 2)) >= 18


@pytest.mark.parametrize("dim", [32, 64, 768])
def test_recall_by_dimension(spark, dim):
    rows = [r for r in _vectors(7, dim) if r[1] and len(r[1]) == dim and r[2] is not None and None not in r[1] and np.isfinite(r[1]).all() and any(r[1]) and r[0] is not None]
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    labels = np.array([r[2] for r in rows])
    near = (x @ x.T >= 0.93) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    got = {r["vec_id"]: r["n_links"] for r in lattice.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    assert sum(got.values()) >= 0.95 * near.sum() and all(got[r[0]] <= n for r, n in zip(rows, near.sum(axis=1)))


def test_only_sets_of_pairs_within_the_bounds_are_stored(spark, monkeypatch):
    """Texts that share a passage meet in buckets; neither their sets nor vectors once a bucket go to disk."""
    kept, real = [], shingle_tree.stored

    def stored(df, name, *rest):
        out = real(df, name, *rest)
        kept.append((name, set(out.columns), out.count()))
        return out

    monkeypatch.setattr(shingle_tree, "stored", stored)
    rng = random.Random(2)
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(50 + 20 * (k % 12))) + " " + passage) for k in range(60)]
    rows += [(100, rows[0][1] + " and one more"), (101, rows[1][1] + " and another")]
    got = {r["doc_id"]: r["component_id"] for r in shingle_tree.near_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == _near(rows)[1] and got[100] == 0 and got[101] == 1
    assert all(n <= 8 for name, columns, n in kept if "grams" in columns)
    assert sum(bool(columns & {"counts", "fine"}) for _, columns, _ in kept) == 1


def test_r_trees_compare_in_small_blocks():
    v = np.full((512, shingle_tree.GROUPS), 3, dtype=np.uint8)
    n = np.full(512, 3 * shingle_tree.GROUPS)
    one, other = RTree(v, n), RTree(v, n)
    tracemalloc.start()
    a, _ = one.joined(other, Threshold())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(a) == 512 * 512 and peak < 32 << 20


def test_counts_that_a_byte_cannot_hold_rule_nothing_out():
    t = Threshold()
    a = np.full((3, shingle_tree.GROUPS), 2, dtype=np.uint8)
    b = a.copy()
    a[1:, 7] = shingle_tree.FULL
    b[1, 7] = shingle_tree.FULL
    assert shingle_tree.allowed(a, b, np.full(3, 10**7), t).tolist() == [False, True, False]
    assert RTree(a, np.full(3, 5 * 10**6)).joined(RTree(b, np.full(3, 5 * 10**6)), t)[0].tolist() == [1, 2]
