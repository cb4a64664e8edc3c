"""Runs of repeated words within a text, by an enhanced suffix array.

A run is a stretch of consecutive words with a smallest period q that no
neighbouring word extends; one counts when it has at least ``least`` words and
``exponent`` periods. Every run of two periods or more ends in one branching
square: two equal neighbouring blocks whose next words differ. The squares are
found without tree nodes, in NumPy over all texts of a slice at once:

1. words become numbers, ranks of 1, 2, 4, … words are doubled until no two suffixes of a
   text tie, which gives suffix array, inverse (ISA) and, from the ranks, the LCP array;
2. every LCP interval of depth d has children, the stretches between its LCP minima; each suffix
   i of all children but the largest looks up ISA[i + d] and ISA[i - d]: inside the
   interval but in another child, it makes a branching square of period d;
3. squares are rotated to the left as far as their words repeat (by the ranks again), and those of one
   stretch merge into one run, which has the least of their periods.

Suffixes of different texts are never compared, so copies of a text cost what
one text costs. Work is O(n log n) per text, without recursion. A text in which no block of
words that a run needs occurs twice is left after the first doublings.

The job is map-only. Memory is that of one slice (1 MB of texts, or one longer text):
some 100 bytes per word, and 8 per word and doubling.

Defined results: a null text has no runs and an empty collapsed text; an empty
text likewise; rows of an empty table, none; repeated rows give equal rows, null ids are kept; other columns are not looked
at. A very long text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.llm.common import _SPACE, text_slices
from quarry.llm.word_bytes import as_strings, join_words, ranges, spans, word_numbers

RUNS_TYPE = "array<struct<start: bigint, length: bigint, period: bigint>>"
BLOCK = 1 << 19  # suffixes of smaller children looked up at a time


def _dense(key: np.ndarray) -> tuple[np.ndarray, int]:
    """Ranks of the keys, equal for equal ones, and how many there are."""
    order = np.argsort(key, kind="stable")
    new = np.empty(len(key), dtype=bool)
    new[:1] = False
    np.not_equal(key[order[1:]], key[order[:-1]], out=new[1:])
    rank = np.empty(len(key), dtype=np.int64)
    number = np.cumsum(new)
    rank[order] = number
    return rank, int(number[-1]) + 1 if len(key) else 0


def _doubled(rank: np.ndarray, step: int, end: np.ndarray) -> tuple[np.ndarray, int]:
    """Ranks of blocks of ``2 * step`` words from those of ``step`` words; a block ends with its text."""
    n = len(rank)
    second = np.zeros(n, dtype=np.int64)
    inside = np.flatnonzero(np.arange(n) + step < end)
    second[inside] = rank[inside + step] + 1
    return _dense(rank * (n + 1) + second)


def _common(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words the suffixes at i and j share; ``levels`` have a closing -1."""
    shared = np.zeros(len(i), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        rank = levels[k]
        shared += (rank[i + shared] == rank[j + shared]) * np.int64(1 << k)
    return shared


def _common_before(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words just before i and just before j (i < j) are equal."""
    shared = np.zeros(len(i), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        a, b = i - shared - (1 << k), j - shared - (1 << k)
        shared += ((a >= 0) & (levels[k][np.maximum(a, 0)] == levels[k][np.maximum(b, 0)])) * np.int64(1 << k)
    return shared


def _bounds(lcp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last suffix-array place of the LCP interval around each boundary ``at`` (between places at - 1 and at)."""
    n, low = len(lcp), [lcp]
    while 2 << (len(low) - 1) <= n:  # minima of 2, 4, … values from each place on
        half = 1 << (len(low) - 1)
        low.append(np.minimum(low[-1][:-half], low[-1][half:]))
    depth = lcp[at]
    left, right = at.copy(), at + 1  # the values of [left, right) are at least ``depth``
    for k in range(len(low) - 1, -1, -1):
        size = 1 << k
        fits = left >= size
        fits[fits] = low[k][left[fits] - size] >= depth[fits]
        left -= fits * size
        fits = right + size <= n
        fits[fits] = low[k][right[fits]] >= depth[fits]
        right += fits * size
    return left - 1, right - 1


def find_runs(numbers: np.ndarray, bounds: np.ndarray, least: int, exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive texts of word numbers: first word (over all texts), length and period, by first word and period."""
    none = np.zeros(0, dtype=np.int64)
    sizes = np.diff(bounds)
    text = np.repeat(np.arange(len(sizes)), sizes)
    if not len(text):
        return none, none, none
    place = np.arange(len(text))
    end = np.repeat(bounds[1:], sizes)
    # a run of period q repeats a block of length - q words at a distance of q
    need = min(max(least - q, (exponent - 1) * q) for q in range(1, least + 1))
    rank, kinds = _dense(text * (int(numbers.max()) + 1) + numbers)
    levels = [rank]
    while kinds < len(rank):
        step = 1 << (len(levels) - 1)
        if step <= need:  # texts without two equal blocks of ``step`` words have no run
            tied = np.bincount(rank, minlength=kinds)[rank] > 1
            some = np.zeros(len(sizes), dtype=bool)
            some[text[tied]] = True
            stay = some[text]
            if not stay.all():
                moved = np.cumsum(stay) - 1
                end, text, place = moved[end[stay] - 1] + 1, text[stay], place[stay]
                levels = [_dense(r[stay])[0] for r in levels]
                rank = levels[-1]
        rank, kinds = _doubled(rank, step, end)
        levels.append(rank)
    if not len(rank) or kinds < len(rank):
        return none, none, none
    n = len(rank)
    suffixes = np.empty(n, dtype=np.int64)
    suffixes[rank] = np.arange(n)
    inverse = np.append(rank, -1)
    levels = [np.append(r, -1).astype(np.int32 if n < 1 << 31 else np.int64) for r in levels]
    lcp = np.full(n, -1, dtype=np.int64)
    lcp[1:] = _common(levels, suffixes[:-1], suffixes[1:])
    lcp[1:][text[suffixes[1:]] != text[suffixes[:-1]]] = -1
    at = np.flatnonzero(lcp > 0)
    if not len(at):
        return none, none, none
    left, right = _bounds(lcp, at)
    order = np.lexsort((at, lcp[at], left))
    at, left, right, depth = at[order], left[order], right[order], lcp[at[order]]
    first = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | (depth[1:] != depth[:-1])))  # one interval each
    many = np.diff(np.append(first, len(at)))
    # children: the stretches before the first, between, and after the last boundary of an interval
    interval = np.repeat(np.arange(len(first)), many + 1)
    low, high = np.empty(len(interval), dtype=np.int64), np.empty(len(interval), dtype=np.int64)
    head = np.cumsum(many + 1) - (many + 1)
    is_head = np.zeros(len(interval), dtype=bool)
    is_head[head] = True
    is_tail = np.zeros(len(interval), dtype=bool)
    is_tail[head + many] = True
    low[is_head], low[~is_head] = left[first], at
    high[is_tail], high[~is_tail] = right[first] + 1, at
    size = high - low
    largest = np.maximum.reduceat(size, head)
    where = np.where(size == largest[interval], np.arange(len(size)), len(size))
    small = np.ones(len(size), dtype=bool)
    small[np.minimum.reduceat(where, head)] = False
    low, high, size, interval = low[small], high[small], size[small], interval[small]
    left, right, depth = left[first][interval], right[first][interval], depth[first][interval]
    squares, periods = [], []
    summed = np.append(0, np.cumsum(size))
    a = 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(summed, summed[a] + BLOCK, side="right")) - 1)
        i = suffixes[ranges(low[a:b], size[a:b])]
        d, lo, hi, l, r = (np.repeat(x[a:b], size[a:b]) for x in (depth, low, high, left, right))
        for other, square in ((i + d, i), (i - d, i - d)):
            ok = (other >= 0) & (other < n)
            seen = inverse[np.where(ok, other, n)]
            ok &= (seen >= l) & (seen <= r) & ((seen < lo) | (seen >= hi))
            squares.append(square[ok])
            periods.append(d[ok])
        a = b
    i, d = np.concatenate(squares), np.concatenate(periods)
    start = i - _common_before(levels, i, i + d)
    stop = i + 2 * d
    fine = stop - start >= np.maximum(least, exponent * d)
    start, stop, d = start[fine], stop[fine], d[fine]
    order = np.lexsort((d, stop, start))
    start, stop, d = start[order], stop[order], d[order]
    one = np.append(True, (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])) if len(start) else np.zeros(0, dtype=bool)
    start, length, d = start[one], (stop - start)[one], d[one]
    order = np.lexsort((d, start))
    return place[start[order]], length[order], d[order]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, exponent: int = 4) -> DataFrame:
    """doc_id; ``runs`` of every text; ``collapsed``, the text without their repeats.

    ``runs``: (start, length, period) in words of the text, by start and period. ``collapsed``: the words joined by
    one space, less those that a run contains after its first period. Words are ``[^\\x20\\x09-\\x0D]+``, told apart by case.
    """
    if least < 2 or exponent < 2:
        raise ValueError("least and exponent must be 2 or more")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = StructType([rows.schema["doc_id"], *StructType.fromDDL(f"runs {RUNS_TYPE}, collapsed string").fields])
    entry = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_slices(batch.column(1)):
                starts, ends, first = spans(~_SPACE[data], offsets)
                begin, length, period = find_runs(word_numbers(data, starts, ends), first, least, exponent)
                covered = np.zeros(len(starts) + 1, dtype=np.int64)
                np.add.at(covered, begin + period, 1)
                np.add.at(covered, begin + length, -1)
                keep = np.cumsum(covered[:-1]) == 0
                text = np.searchsorted(first, begin, side="right") - 1
                lists = pa.LargeListArray.from_arrays(
                    pa.array(np.searchsorted(text, np.arange(b - a + 1)), pa.int64()),
                    pa.StructArray.from_arrays([pa.array(begin - first[text]), pa.array(length), pa.array(period)], fields=list(entry)),
                )
                kept = np.append(0, np.cumsum(keep))[first]
                texts = as_strings(*join_words(data, starts, ends, np.flatnonzero(keep), kept))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), lists.cast(pa.list_(entry)), texts.cast(pa.string())], ["doc_id", "runs", "collapsed"]
                )

    return rows.mapInArrow(run, schema)


def with_planted_repeats(docs: DataFrame, hashed: Column, text_col: str = "text") -> DataFrame:
    """Texts of rows whose ``hashed`` number h ends in 0 repeat a stretch of their own words.

    With g = h div 10 and n words, word i >= a = g mod n becomes word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8). Such texts
    have known runs, which tells whether a detector finds them. A null hash or text, and a text without words, stay as they are.
    """
    g = F.call_function("div", hashed, F.lit(10))
    words = F.filter(F.split(F.col(text_col), "[ \t-\r]+"), lambda w: w != "")

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = (g % F.nullif(n, F.lit(0))).cast("int")
        p = (1 + F.call_function("div", n - a, 3 + g % 8)).cast("int")
        again = F.transform(F.sequence(a, n - 1), lambda i: F.get(w, a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a), again), " ")).otherwise("")

    text = F.when((hashed % 10 == 0) & F.col(text_col).isNotNull(), F.get(F.transform(F.array(words), repeated), 0)).otherwise(F.col(text_col))
    return docs.withColumn(text_col, text)


def run_digest(found: DataFrame) -> DataFrame:
    """One row per text: how many runs, the longest one, and digests of all runs and of the collapsed text."""
    runs = F.col("runs")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    out = found.select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), longest.alias("longest"),
        F.sha2(F.when(F.size(runs) > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
    return out.select(
        "doc_id", "n_runs", (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
        F.call_function("div", F.col("longest.length") * 1000, -F.col("longest.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
