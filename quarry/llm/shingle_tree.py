"""N-gram Jaccard join: count vectors in R-trees bound the overlap, surviving pairs are verified.

A document's set holds the hashes of its distinct five-word shingles (of its whole word sequence, if shorter); two
documents link when 100 * intersection >= 75 * union. Steps:

1. Documents of equal sets are one class; everything below compares classes.
2. All shingles of the corpus are counted in a fixed-size sketch. It orders
   shingles: those of uncommon slots by hash, then ever more common ones. Linked sets share a shingle among the
   first n - ceil(0.75 n) + 1 of this order (prefix filter); these are joined by
   shingle. The sketch steers cost only: the filter is exact under any order.
3. Buckets with the same classes are one. Every class in a shared bucket gets its count vector: shingles per hash group. The sum of coordinate minima of two vectors bounds
   the sets' intersection from above.
4. Each bucket's classes are compared with one of them, its centre: by size, by finer counts, and what is left on the sets, which are
   made again from the texts of these classes only. Buckets whose classes
   are by then of one component hold no further news. In the others the
   vectors are indexed in an R-tree (sort-tile leaves, nodes with coordinate maxima and least sizes); a descent over
   node pairs drops those whose bound is too low and members already joined, and what
   survives is verified. Buckets are dealt in pairs of chunks, so no task holds a large one, and a
   family of near copies costs its size, not its square.
5. Components of the links give every document the smallest id reachable.

Defined results: no words (null or empty text) is an empty set, linked with nothing; a null id links with nothing and is
its own component; repeated rows are equal documents; an empty table gives an empty result; other columns are
not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import lean, mix, released, stored, text_slices, word_hashes, word_spans
from quarry.llm.components import components

WORDS = 5
GROUPS = 512         # coordinates of a count vector, half a byte or a byte each
FULL = 255           # what a byte cannot exceed: such a coordinate bounds nothing
SLOT_BITS = 20       # of the shingle sketch
SKETCH_FAN_IN = 64   # sketches that one task adds up
BROADCAST_IDS = 500_000  # document ids to reread, 8 bytes each; beyond it they are joined by a shuffle
CHUNK = 512          # classes per chunk of a large bucket
FINE = 2048          # groups of the finer counts that a pair is checked with before its sets are read
PAIRS = 2000         # pairs whose vectors are compared at a time
SMALL = 8            # buckets of up to so many classes are one leaf: their pairs are bounded together
LEAF = 16            # classes per R-tree leaf, and children per node
SET_BYTES = 2 << 20  # sets or counts that a task gives at a time, or one larger set
TOLD = 1_000_000     # pairs a task remembers to have given; beyond it a pair may come twice, and is made distinct later


@dataclass(frozen=True)
class Threshold:
    """Sets link when ``whole`` * intersection >= ``part`` * union."""

    part: int = 75
    whole: int = 100

    def prefix(self, n: int) -> int:
        """How many first shingles of a set of n any linked set must share one of."""
        return n - -(-self.part * n // self.whole) + 1

    def least_overlap(self, sizes):
        """Least intersection of linked sets, from the sum of their sizes: whole * o >= part * (sizes - o)."""
        return -(-self.part * sizes // (self.part + self.whole))


# ---- sets -------------------------------------------------------------------

def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text of an Arrow column."""
    odd = [np.uint64(pow(0xD1342543DE82EF95, k + 1, 1 << 64)) for k in range(WORDS)]
    for at, end, data, offsets in text_slices(column):
        starts, ends, first = word_spans(data, offsets)
        h = word_hashes(data, starts, ends)
        n = max(len(h) - WORDS + 1, 0)
        grams = mix(sum((h[k : k + n] * odd[k] for k in range(WORDS)), np.zeros(n, np.uint64)))
        for r in range(end - at):
            a, b = int(first[r]), int(first[r + 1])
            if b - a >= WORDS:
                yield at + r, np.unique(grams[a : b - WORDS + 1])
            elif b > a:
                short = np.array([b - a], dtype=np.uint64)
                for k in range(b - a):
                    short = mix(h[a + k : a + k + 1] * odd[k] + short)
                yield at + r, short
            else:
                yield at + r, np.zeros(0, np.uint64)


def class_key(grams: np.ndarray) -> int:
    """A signed 64-bit name of the set."""
    with np.errstate(over="ignore"):
        total = grams.sum(dtype=np.uint64) + np.uint64(len(grams)) * np.uint64(0x9E3779B97F4A7C15)
        other = mix(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(mix(np.array([mix(np.array([total], np.uint64))[0] ^ other], np.uint64)).view(np.int64)[0])


def _slots(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def commonness(sketch: np.ndarray) -> np.ndarray:
    """Per slot 0 where its count is what chance gives, else growing with the logarithm of the excess."""
    mean = sketch.mean()
    return np.log2(1 + np.maximum(0.0, sketch - mean - 4 * np.sqrt(mean) - 4)).astype(np.uint8)


def prefix(grams: np.ndarray, common: np.ndarray, t: Threshold) -> np.ndarray:
    level = common[_slots(grams)]
    n = t.prefix(len(grams))
    if level.any():
        return grams[np.argsort(level, kind="stable")[:n]]  # by level, then by hash
    return grams[:n]


# ---- passes over the texts --------------------------------------------------

def _profiles(texts: DataFrame, id_type: str) -> DataFrame:
    """(doc_id, n, class, sketch): a row per text, and at the end of each task its sketch, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, names = np.zeros(1 << SLOT_BITS, dtype=np.uint32), ["doc_id", "n", "class", "sketch"]
        kind = None
        for batch in batches:
            kind = batch.column(0).type
            n, keys = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for r, grams in shingle_sets(batch.column(1)):
                n[r], keys[r] = len(grams), class_key(grams)
                np.add.at(sketch, _slots(grams), np.uint32(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(keys), pa.nulls(batch.num_rows, pa.binary())], names)
        if kind is not None:
            packed = zlib.compress(sketch.tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([packed], pa.binary())], names)

    return texts.mapInArrow(lean(run), f"doc_id {id_type}, n long, class long, sketch binary")


def _sum_sketches(sketches: DataFrame) -> np.ndarray:
    """The sum of all tasks' sketches, added up by tasks until few are left; the driver gets those."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for s in batch.column(0):
                one = np.frombuffer(zlib.decompress(s.as_py()), dtype=np.uint32)
                total = one.copy() if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], ["sketch"])

    left = sketches.count()
    while left > SKETCH_FAN_IN:
        left = -(-left // SKETCH_FAN_IN)
        sketches = stored(sketches.repartition(left).mapInArrow(add, "sketch binary"), "sketches")
    total = np.zeros(1 << SLOT_BITS, dtype=np.uint64)
    for row in sketches.toLocalIterator():
        total += np.frombuffer(zlib.decompress(row["sketch"]), dtype=np.uint32)
    return total


def _prefixes(texts: DataFrame, common: np.ndarray, t: Threshold) -> DataFrame:
    """(key, class) of the first shingles of each set; a task gives equal sets once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        keys: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(owners))], ["key", "class"]
            )

        for batch in batches:
            for _, grams in shingle_sets(batch.column(1)):
                if not len(grams) or (name := class_key(grams)) in seen:
                    continue
                seen.add(name)
                first = prefix(grams, common, t)
                keys.append(first)
                owners.append(np.full(len(first), name, dtype=np.int64))
                size += len(first)
                if size > 100_000:
                    yield out()
                    keys, owners, size = [], [], 0
        if size:
            yield out()

    return texts.where("doc_id IS NOT NULL").mapInArrow(lean(run), "key long, class long")


def shared_buckets(entries: DataFrame) -> DataFrame:
    """The distinct (key, class) rows whose key has more than one class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row: (key, class, whether its bucket has another row, whether it went out)
        for batch in batches:
            key, owner = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(key):
                continue
            if held:
                key, owner = np.append(held[0], key), np.append(held[1], owner)
            new = np.append(True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1]))
            key, owner = key[new], owner[new]
            same = key[1:] == key[:-1]
            shared = np.append(False, same) | np.append(same, False)
            if held:
                shared[0] |= held[2]
            go = shared.copy()
            if held and held[3]:
                go[0] = False
            held = (key[-1], owner[-1], bool(shared[-1]), bool(shared[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(key[go]), pa.array(owner[go])], ["key", "class"])

    return entries.repartition("key").sortWithinPartitions("key", "class").mapInArrow(lean(run), "key long, class long")


def _counted(grams: np.ndarray, groups: int) -> bytes:
    """Shingles per group: half a byte each where all are below 16, else a byte each."""
    counts = np.minimum(np.bincount((grams & np.uint64(groups - 1)).astype(np.int64), minlength=groups), FULL).astype(np.uint8)
    return (counts[::2] << 4 | counts[1::2] if counts.max() < 16 else counts).tobytes()


def _vectors(column: pa.ChunkedArray | pa.Array, groups: int) -> np.ndarray:
    """The rows of ``_counted`` as a matrix of bytes."""
    rows = column.to_pylist()
    out = np.zeros((len(rows), groups), dtype=np.uint8)
    size = np.array([len(r) for r in rows])
    whole, half = np.flatnonzero(size == groups), np.flatnonzero(size == groups // 2)
    out[whole] = np.frombuffer(b"".join(rows[i] for i in whole), np.uint8).reshape(-1, groups)
    packed = np.frombuffer(b"".join(rows[i] for i in half), np.uint8).reshape(-1, groups // 2)
    out[half, ::2], out[half, 1::2] = packed >> 4, packed & 15
    return out


def _in_slices(rows: Iterator[tuple], nbytes: Callable[..., int], out: Callable[[list], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about ``SET_BYTES``, or of one larger row."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += nbytes(*row)
        if size > SET_BYTES:
            yield out(held)
            held, size = [], 0
    if held:
        yield out(held)


def _named_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    for batch in batches:
        for _, grams in shingle_sets(batch.column(1)):
            if len(grams):
                yield class_key(grams), grams


# a class has one row in these two unless ids repeat; then its pairs are found twice, and made distinct later

def _counts(texts: DataFrame) -> DataFrame:
    """(class, n, counts, fine): size and shingles per group, coarse and fine, of the set of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((name, len(g), _counted(g, GROUPS), _counted(g, FINE)) for name, g in _named_sets(batches))
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        yield from _in_slices(rows, lambda _, n, counts, fine: len(counts) + len(fine), lambda held: pa.RecordBatch.from_arrays(
            [pa.array(x, kind) for x, kind in zip(zip(*held), kinds)], ["class", "n", "counts", "fine"]))

    return texts.mapInArrow(lean(run), "class long, n long, counts binary, fine binary")


def _sets(texts: DataFrame) -> DataFrame:
    """(class, n, grams): the set of each text."""

    def out(held: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        sizes = [len(g) for _, g in held]
        grams = pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes))), pa.array(np.concatenate([g for _, g in held]).view(np.int64)))
        return pa.RecordBatch.from_arrays(
            [pa.array([name for name, _ in held], pa.int64()), pa.array(sizes, pa.int64()), grams.cast(pa.list_(pa.int64()))], ["class", "n", "grams"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _in_slices(_named_sets(batches), lambda _, g: g.nbytes, out)

    return texts.mapInArrow(lean(run), "class long, n long, grams array<long>")


def told_apart(buckets: DataFrame) -> DataFrame:
    """``buckets`` (key, class) without those whose classes are the same as another's.

    Two long texts with much in common share thousands of buckets; one says it all.
    """
    same = ["n", "low", "high", "mixed"]
    members = buckets.groupBy("key").agg(
        F.count("*").alias("n"), F.min("class").alias("low"), F.max("class").alias("high"), F.bit_xor(F.xxhash64("class")).alias("mixed"))
    return buckets.join(members.groupBy(*same).agg(F.min("key").alias("key")).select("key"), "key", "left_semi")


# ---- candidates -------------------------------------------------------------

def allowed(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, t: Threshold) -> np.ndarray:
    """Which rows of two matrices of counts may be of linked sets, by the sum of coordinate minima and the sum of the sets' sizes."""
    least = np.minimum(a, b)
    full = (least == FULL).any(axis=1)  # as a byte cannot exceed it, there may be more
    return full | (least.sum(axis=1, dtype=np.int64) >= t.least_overlap(sizes))


class RTree:
    """Count vectors in sort-tile order; every node has its members' coordinate maxima and least set size."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray) -> None:
        self.order = self._tiles(vectors, sizes)
        self.levels = [(vectors[self.order], sizes[self.order])]
        while len(self.levels[-1][1]) > 1:
            top, least = self.levels[-1]
            cuts = np.arange(0, len(least), LEAF)
            self.levels.append((np.maximum.reduceat(top, cuts, axis=0), np.minimum.reduceat(least, cuts)))

    @staticmethod
    def _tiles(vectors: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """By set size in slabs, and within a slab by the most varied coordinate."""
        by_size = np.argsort(sizes, kind="stable")
        slab = LEAF * max(1, round((len(sizes) / LEAF) ** 0.5))
        out = []
        for a in range(0, len(sizes), slab):
            s = by_size[a : a + slab]
            out.append(s[np.argsort(vectors[s, vectors[s].var(axis=0).argmax()], kind="stable")])
        return np.concatenate(out)

    def joined(self, other: RTree, t: Threshold) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of members (of this tree, of the other) whose bound allows a link."""
        depth = max(len(self.levels), len(other.levels)) - 1
        pairs = np.zeros((1, 2), dtype=np.int64)
        for d in range(depth, -1, -1):
            mine, theirs = (x.levels[min(d, len(x.levels) - 1)] for x in (self, other))
            if d < depth:
                pairs = self._children(pairs, len(mine[1]) if d < len(self.levels) - 1 else 1, len(theirs[1]) if d < len(other.levels) - 1 else 1)
            keep = np.zeros(len(pairs), dtype=bool)
            for a in range(0, len(pairs), PAIRS):
                i, j = pairs[a : a + PAIRS].T
                keep[a : a + PAIRS] = allowed(mine[0][i], theirs[0][j], mine[1][i] + theirs[1][j], t)
            pairs = pairs[keep]
        return self.order[pairs[:, 0]], other.order[pairs[:, 1]]

    @staticmethod
    def _children(pairs: np.ndarray, n_mine: int, n_theirs: int) -> np.ndarray:
        """All child pairs of node pairs; a tree with one node at this level keeps it."""
        step = np.arange(LEAF)
        i = pairs[:, 0, None] * LEAF + step if n_mine > 1 else pairs[:, 0, None]
        j = pairs[:, 1, None] * LEAF + step if n_theirs > 1 else pairs[:, 1, None]
        grid = np.stack(np.broadcast_arrays(i[:, :, None], j[:, None, :]), axis=-1).reshape(-1, 2)
        return grid[(grid[:, 0] < n_mine) & (grid[:, 1] < n_theirs)]


def _tree_pairs(units: DataFrame, t: Threshold) -> DataFrame:
    """(a, b) classes of one unit (key, i, j) of different components whose vectors allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, told_of = np.zeros(0, np.uint64), None  # pairs given for these chunks of buckets with one lowest class

        def fresh(group: np.ndarray, a: np.ndarray, b: np.ndarray, remember: bool) -> Iterator[pa.RecordBatch]:
            nonlocal told, told_of
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
            if remember:
                if told_of != tuple(group):
                    told, told_of = np.zeros(0, np.uint64), tuple(group)
                code = mix(pairs[:, 0].copy().view(np.uint64) ^ mix(pairs[:, 1].copy().view(np.uint64)))
                new = ~np.isin(code, told)
                pairs, told = pairs[new], np.concatenate([told, code[new]])[-TOLD:]
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])

        def out(table: pa.Table) -> Iterator[pa.RecordBatch]:
            key = np.stack([table.column(c).to_numpy() for c in ("low", "i", "j", "key")], axis=1)
            owner, part, n, half = (table.column(c).to_numpy() for c in ("class", "component", "n", "half"))
            vectors = _vectors(table.column("counts"), GROUPS)
            first = np.append(0, np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1)
            size = np.diff(np.append(first, len(key)))
            room = np.repeat(first + size, size) - np.arange(len(key))  # members of the unit from here on
            whole = np.repeat(size <= SMALL, size) & (half == 2)
            for step in range(1, SMALL):
                a = np.flatnonzero(whole & (room > step))
                a = a[part[a] != part[a + step]]
                for c in range(0, len(a), PAIRS):
                    x = a[c : c + PAIRS]
                    y = x + step
                    keep = allowed(vectors[x], vectors[y], n[x] + n[y], t)
                    if keep.any():
                        yield from fresh(key[x[0], :3], owner[x[keep]], owner[y[keep]], False)
            for r in (np.arange(f, f + m) for f, m in zip(first, size) if not whole[f]):
                left, right = r[half[r] != 1], r[half[r] != 0]
                if not len(left) or not len(right):
                    continue
                a, b = RTree(vectors[left], n[left]).joined(RTree(vectors[right], n[right]), t)
                a, b = left[a], right[b]
                keep = part[a] != part[b]
                if keep.any():
                    yield from fresh(key[r[0], :3], owner[a[keep]], owner[b[keep]], True)

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            named = np.stack([batch.column(c).to_numpy() for c in range(4)], axis=1)
            begins = np.flatnonzero((named != named[-1]).any(axis=1))
            begins = int(begins[-1]) + 1 if len(begins) else 0
            if held and (begins or any(held[-1].column(c)[0].as_py() != int(named[0, c]) for c in range(4))):
                yield from out(pa.Table.from_batches([*held, batch.slice(0, begins)]))
                held = []
            elif begins:
                yield from out(pa.Table.from_batches([batch.slice(0, begins)]))
            held.append(batch.slice(begins))
        if held:
            yield from out(pa.Table.from_batches(held))

    # buckets of one family mostly have the same lowest class: chunk by chunk they come to one task, which gives a pair once
    columns = ["low", "i", "j", "key", "class", "component", "n", "half", "counts"]
    ordered = units.repartition("low", "i", "j").sortWithinPartitions("low", "i", "j", "key").select(*columns)
    return ordered.mapInArrow(lean(run), "a long, b long")


def _units(buckets: DataFrame) -> DataFrame:
    """``buckets`` (key, class, component) dealt as pairs (i, j) of chunks; ``half`` is 0 or 1, or 2 where i = j."""
    sizes = buckets.groupBy("key").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"), F.min("class").alias("low"))
    mine = F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int")
    return (
        buckets.join(sizes, "key").withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other"))
        .withColumn("half", F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1))
    )


def _bounded(pairs: DataFrame, t: Threshold) -> DataFrame:
    """Pairs (a, n_a, fine_a, b, n_b, fine_b) whose fine counts allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PAIRS):
                part = batch.slice(at, PAIRS)
                fine = [_vectors(part.column(c), FINE) for c in (2, 5)]
                keep = allowed(*fine, part.column(1).to_numpy() + part.column(4).to_numpy(), t)
                yield pa.RecordBatch.from_arrays([pa.array(part.column(c).to_numpy()[keep]) for c in (0, 3)], ["a", "b"])

    return pairs.mapInArrow(lean(run), "a long, b long")


def _of_like_size(pairs: DataFrame, counts: DataFrame, t: Threshold) -> DataFrame:
    """The distinct ``pairs`` (a, b) of classes whose sizes allow a link: no more than the smaller set can be in both."""
    for x in ("a", "b"):
        pairs = pairs.join(counts.select(F.col("class").alias(x), F.col("n").alias(f"n_{x}")), x)
    both = F.least("n_a", "n_b")
    return pairs.where(F.lit(t.whole) * both >= F.lit(t.part) * (F.col("n_a") + F.col("n_b") - both)).select("a", "b").distinct()


def _verified(pairs: DataFrame, counts: DataFrame, reread: Callable[[DataFrame], DataFrame], t: Threshold) -> DataFrame:
    """The pairs (a, b) of classes that link: by their sizes, by the bound on the fine counts, then by the sets, which ``reread`` gives."""

    def joined(pairs: DataFrame, rows: DataFrame, column: str) -> DataFrame:
        few = pairs.count() <= BROADCAST_IDS
        for x in ("a", "b"):  # the columns are large: only those of classes in a pair move
            side = rows.select(F.col("class").alias(x), F.col("n").alias(f"n_{x}"), F.col(column).alias(f"{column}_{x}"))
            asked = pairs.select(x).distinct()
            pairs = pairs.join(side.join(F.broadcast(asked) if few else asked, x, "left_semi"), x)
        return pairs

    asked = stored(_of_like_size(pairs, counts, t), "shingle-pairs")
    fine = joined(asked, counts, "fine").select("a", "n_a", "fine_a", "b", "n_b", "fine_b")
    bounded = stored(_bounded(fine, t).distinct(), "shingle-pairs")
    released(asked)
    sets = stored(_sets(reread(bounded.select(F.col("a").alias("class")).union(bounded.select("b")).distinct())), "shingle-sets")
    near = joined(bounded, sets, "grams")
    both = F.size(F.array_intersect("grams_a", "grams_b"))
    union = F.col("n_a") + F.col("n_b") - both
    links = stored(near.where(F.lit(t.whole) * both >= F.lit(t.part) * union).select("a", "b").distinct(), "shingle-links")
    released(bounded, sets)
    return links


def _joined_parts(buckets: DataFrame, links: DataFrame) -> DataFrame:
    """``buckets`` whose classes are of more than one component of ``links``, with the components."""
    part = buckets.join(components(links).withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class"))
    mixed = part.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    return part.join(mixed, "key")


def _rereads(docs: DataFrame, ids: DataFrame, limit: int) -> DataFrame:
    """The rows of ``docs`` with one of the ids."""
    ids = stored(ids, "shingle-ids")
    return docs.join(F.broadcast(ids) if ids.count() <= limit else ids, "doc_id", "left_semi")


def near_documents(
    docs: DataFrame, t: Threshold = Threshold(), id_col: str = "doc_id", text_col: str = "text", broadcast_ids: int = BROADCAST_IDS
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    profiles = stored(_profiles(texts, dict(texts.dtypes)["doc_id"]), "shingle-profiles")
    common = commonness(_sum_sketches(profiles.where("sketch IS NOT NULL").select("sketch")))
    named = profiles.where("sketch IS NULL").select("doc_id", "n", "class")
    classes = stored(
        named.where("doc_id IS NOT NULL AND n > 0").groupBy("class").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "shingle-classes"
    )
    buckets = stored(shared_buckets(_prefixes(texts, common, t)), "shingle-buckets")
    every = buckets
    buckets = stored(told_apart(every), "shingle-buckets")
    released(every)

    def reread(wanted: DataFrame) -> DataFrame:
        return _rereads(texts, classes.join(wanted, "class", "left_semi").select(F.col("rep").alias("doc_id")), broadcast_ids)

    counts = stored(_counts(reread(buckets.select("class").distinct())), "shingle-counts")

    centre = buckets.groupBy("key").agg(F.min_by("class", F.xxhash64("class", "key")).alias("centre"))
    spokes = buckets.join(centre, "key").where("class <> centre").select(
        F.least("class", "centre").alias("a"), F.greatest("class", "centre").alias("b"))
    links = _verified(spokes, counts, reread, t)
    mixed = stored(_joined_parts(buckets, links), "shingle-mixed")
    released(buckets)
    units = _units(mixed).join(counts.select("class", "n", "counts"), "class")
    more = _verified(_tree_pairs(units, t), counts, reread, t)
    released(mixed, counts)

    by_rep = links.union(more)
    for x in ("a", "b"):
        by_rep = by_rep.join(classes.select(F.col("class").alias(x), F.col("rep").alias(f"rep_{x}")), x)
    joined = components(by_rep.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")))
    lead = classes.join(joined.withColumnRenamed("node", "rep"), "rep", "left").where("copies > 1 OR component IS NOT NULL").select(
        "class", F.coalesce("component", "rep").alias("component"))
    own: Column = F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("component"))
    return named.join(lead, "class", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce(own, F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, t: Threshold = Threshold(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the one with its smallest id.

    Rows that share an id stay or go together, rows with a null id stay; all columns are kept.
    """
    lost = near_documents(docs, t, id_col, text_col).where("doc_id <> component_id").select(F.col("doc_id").alias("_lost")).distinct()
    return docs.join(lost, docs[id_col] == lost["_lost"], "left_anti")
