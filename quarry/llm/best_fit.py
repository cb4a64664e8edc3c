"""Vector best-fit packing of token pieces into sequences.

Every piece is a vector (tokens, documents, attention cost) = (n, 1, n * n), so
its length alone says what it needs. Pieces of one length are interchangeable,
and so are open sequences with the same residual vector. Best-fit decreasing
over all pieces is therefore run on the histogram of lengths, which has at most
``Capacity.tokens`` rows whatever the corpus size: a length's pieces fill the
feasible group of sequences with the best score, then the next best, and open
new sequences for the rest. The outcome is a short list of runs ("pieces of
length n ranked r0 to r1 go to sequences b, b+1, ..., k in each"), which Spark
joins back to the ranked pieces. No task and no driver sees the pieces of more
than one salted group.

Null texts are empty and hold the end id alone. Null or repeated document ids
are kept as rows of their own. An empty table gives an empty result. Columns of
the input other than id and text are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import stored
from quarry.llm.tokens import cuts, encoded_batches, id_and_text

# Pieces of one length that one task ranks, on average; the number of salts follows from it.
GROUP_ROWS = 200_000
LEAST_SALTS = 32


@dataclass(frozen=True)
class Capacity:
    """What one sequence can hold, the weight of each dimension in the score, and the score.

    ``measure='norm'`` takes the sequence whose residual vector is shortest after
    placing; ``'dot'`` the one whose residual has the smallest weighted product
    with the piece. Both are over residuals divided by the capacities.
    """

    tokens: int = 1024
    documents: int = 1024
    cost: int = 1024 * 1024
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)
    measure: str = "norm"

    def __post_init__(self) -> None:
        if self.measure not in ("norm", "dot"):
            raise ValueError(f"unknown measure {self.measure!r}")
        if self.documents < 1 or self.cost < self.tokens * self.tokens:
            raise ValueError("a full-length piece must fit into an empty sequence")

    def vector(self, length: int) -> np.ndarray:
        return np.array([length, 1, length * length], dtype=np.int64)

    @property
    def whole(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.cost], dtype=np.int64)

    def scores(self, residual: np.ndarray, need: np.ndarray) -> np.ndarray:
        """One score per residual row; lower is better."""
        scale, w = self.whole.astype(float), np.array(self.weights)
        if self.measure == "dot":
            return ((residual / scale) * (need / scale) * w).sum(axis=1)
        return (w * ((residual - need) / scale) ** 2).sum(axis=1)


def plan(histogram: Iterable[tuple[int, int]], cap: Capacity) -> list[tuple[int, int, int, int, int, int]]:
    """Vector best-fit decreasing over (length, count): runs (length, rank from, rank to, sequence, per sequence, offset).

    The piece of rank r of a run goes to sequence ``sequence + (r - from) // per``
    at ``offset + (r - from) % per * length``.
    """
    residual = np.zeros((0, 3), dtype=np.int64)  # one row per group of equal open sequences
    spans: list[list[tuple[int, int]]] = []      # their numbers, as ranges
    runs: list[tuple[int, int, int, int, int, int]] = []
    opened = 0

    def add(res: np.ndarray, span: tuple[int, int]) -> None:
        nonlocal residual
        if res.min() <= 0:  # one dimension is used up: closed
            return
        same = np.flatnonzero((residual == res).all(axis=1))
        if len(same):
            spans[same[0]].append(span)
        else:
            residual = np.vstack([residual, res])
            spans.append([span])

    for length, left in sorted(histogram, reverse=True):
        need, rank = cap.vector(length), 0
        while left:
            fits = np.flatnonzero((residual >= need).all(axis=1))
            if len(fits):
                g = int(fits[np.argmin(cap.scores(residual[fits], need))])
                res = residual[g].copy()
                lo, hi = spans[g].pop()
                if not spans[g]:
                    del spans[g]
                    residual = np.delete(residual, g, axis=0)
            else:
                res = cap.whole.copy()
                per = int((res // need).min())
                lo, hi = opened, opened + -(-left // per)
                opened = hi
            per = int((res // need).min())
            used = cap.tokens - int(res[0])
            bins = min(hi - lo, left // per)
            if bins:
                runs.append((length, rank, rank + bins * per, lo, per, used))
                rank, left = rank + bins * per, left - bins * per
                add(res - need * per, (lo, lo + bins))
                lo += bins
            if left and lo < hi:  # fewer than ``per`` remain: one more sequence takes them
                runs.append((length, rank, rank + left, lo, left, used))
                add(res - need * left, (lo, lo + 1))
                rank, left, lo = rank + left, 0, lo + 1
            if lo < hi:
                add(res, (lo, hi))
    return runs


def pieces(
    docs: DataFrame, tokenizer_path: str, size: int, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document: its ids, closed by the end id, cut losslessly.

    ``ids`` are little-endian unsigned 32-bit values. Only documents of more than ``size`` ids are cut.
    """
    id_type = dict(docs.dtypes)[id_col]
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, arrays in encoded_batches(batches, tokenizer_path):
            rows = [
                (d, k, s, n, raw) for d, a in zip(ids, arrays) for k, (s, n) in enumerate(cuts(len(a), size))
                for raw in (a[s : s + n].tobytes(),)
            ]
            d, k, s, n, raw = zip(*rows)
            out = [pa.array(d), pa.array(k, pa.int32()), pa.array(s, pa.int64()), pa.array(n, pa.int64())]
            out.append(pa.array([zlib.crc32(r) for r in raw], pa.int64()))
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                out.append(pa.array(raw, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    return id_and_text(docs, id_col, text_col).mapInArrow(cut, schema)


def pack(items: DataFrame, cap: Capacity) -> DataFrame:
    """``items`` (with ``doc_id``, ``piece``, ``length`` of 1 to ``cap.tokens``) plus ``sequence_id`` and ``offset``.

    ``items`` is read three times: pass a stored table. Ranks are dealt by
    length and salt, the number of salts growing with the rows, so a length that
    a third of all pieces share is spread over many tasks.
    """
    spark = items.sparkSession
    histogram = [(r["length"], r["n"]) for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()]
    if any(not 1 <= n <= cap.tokens for n, _ in histogram):
        raise ValueError("a piece has no length between 1 and the capacity")
    salts = max(LEAST_SALTS, -(-sum(c for _, c in histogram) // GROUP_ROWS))
    salted = items.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    before = (
        salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
        .withColumn("first", F.coalesce(F.sum("n").over(
            Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select("length", "salt", "first")
    )
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece")
    ranked = (
        salted.withColumn("place", F.row_number().over(within) - 1)
        .join(before, ["length", "salt"])
        .withColumn("rank", F.col("first") + F.col("place"))
    )
    runs = spark.createDataFrame(
        plan(histogram, cap) or [], "length long, r0 long, r1 long, sequence0 long, per long, offset0 long"
    )
    # at most a few runs per length, and lengths are bounded by the capacity
    within_run = F.col("rank") - F.col("r0")
    return (
        ranked.join(F.broadcast(runs), (ranked["length"] == runs["length"]) & (F.col("rank") >= F.col("r0")) & (F.col("rank") < F.col("r1")))
        .withColumn("sequence_id", F.col("sequence0") + F.floor(within_run / F.col("per")).cast("long"))
        .withColumn("offset", F.col("offset0") + within_run % F.col("per") * ranked["length"])
        .select(*[ranked[c] for c in items.columns], "sequence_id", "offset")
    )


def pack_documents(
    docs: DataFrame, tokenizer_path: str, cap: Capacity = Capacity(), id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Tokenize, cut and pack whole documents; one row per piece. The pieces are written once to the shared folder."""
    return pack(stored(pieces(docs, tokenizer_path, cap.tokens, id_col, text_col, with_ids), "pieces"), cap)
