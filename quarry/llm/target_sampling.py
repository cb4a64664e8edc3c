"""Documents drawn in proportion to how much they look like a target corpus.

Features of a text are its runs of one to ``Grams.longest`` words; each is hashed to one of
``Grams.buckets`` buckets. A bucket's gain is the logarithm of its share in the target over its share
in the raw corpus, a document's weight the mean gain of its features. Adding Gumbel noise and taking the
highest scores draws without replacement in proportion to the weights.

The features of a slice of texts (1 MB, or one longer text) are interned in an open-addressed NumPy table: keys are
xxhash64 values, computed for all features at once; every feature probes slots from its key on, the last one to write an empty slot
owns it, and a feature stays at a slot only if key, length and bytes are the owner's. So no two features share a
slot, whatever their hashes. A slot stores its bucket (crc32 of the bytes, taken once per distinct feature) and its
count; counts per bucket are added up per task, and what leaves a task is one row per bucket. To weigh documents, the slots get their
buckets' gains and the features' slot numbers gather them.

What reaches the driver is one row per bucket, at any size of the corpus. Ranks come from a stored
table sorted by range: place within a partition plus the rows of earlier ones; no window over the table.

Defined results: a null text has no features, weight 0; equal rows get equal weights, and ranks next to each other in any order;
a null id counts as an empty one in the noise and comes last among ties; empty tables give no rows; with an empty target, gains are those
of no counts; other columns are not looked at. Memory is that of one slice, some 150 bytes per word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quarry.llm.common import lowered, stored, text_slices
from quarry.llm.word_bytes import join_words, spans

# The primes of xxhash64.
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
LANES = 32  # bytes; longer features are hashed and compared one by one

_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass(frozen=True)
class Grams:
    """Features: runs of 1 to ``longest`` words, in ``buckets`` buckets."""

    longest: int = 2
    buckets: int = 10_000


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def xxhash64(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """xxhash64 (seed 0) of byte ranges. ``data`` is followed by 8 bytes of padding."""
    eights = np.ndarray((max(len(data) - 7, 0),), dtype="<u8", buffer=data, strides=(1,))
    h = P5 + sizes.astype(np.uint64)
    at = starts.copy()
    for k in range(3):  # up to three lanes of 8 bytes
        on = np.flatnonzero((sizes >= 8 * (k + 1)) & (sizes < LANES))
        if not len(on):
            break
        lane = _turned(eights[at[on]] * P2, 31) * P1
        h[on] = _turned(h[on] ^ lane, 27) * P1 + P4
        at[on] += 8
    on = np.flatnonzero((sizes & 4 != 0) & (sizes < LANES))
    h[on] = _turned(h[on] ^ ((eights[at[on]] & np.uint64(0xFFFFFFFF)) * P1), 23) * P2 + P3
    at[on] += 4
    for k in range(3):  # up to three single bytes
        on = np.flatnonzero((sizes & 3 > k) & (sizes < LANES))
        h[on] = _turned(h[on] ^ (data[at[on]].astype(np.uint64) * P5), 11) * P1
        at[on] += 1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    h ^= h >> np.uint64(32)
    buffer = memoryview(data)
    for i in np.flatnonzero(sizes >= LANES).tolist():
        h[i] = xxhash.xxh64_intdigest(buffer[starts[i] : starts[i] + sizes[i]])
    return h


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the ranges of ``sizes`` bytes at a and at b are equal."""
    eights = np.ndarray((max(len(data) - 7, 0),), dtype="<u8", buffer=data, strides=(1,))
    same = np.ones(len(a), dtype=bool)
    for k in range(0, LANES, 8):
        on = np.flatnonzero((sizes > k) & (sizes < LANES))
        if not len(on):
            break
        cut = np.uint64(8) * (8 - np.minimum(sizes[on] - k, 8)).astype(np.uint64)
        same[on] &= ((eights[a[on] + k] ^ eights[b[on] + k]) << cut) == 0
    buffer = memoryview(data)
    for i in np.flatnonzero(sizes >= LANES).tolist():
        same[i] = buffer[a[i] : a[i] + sizes[i]] == buffer[b[i] : b[i] + sizes[i]]
    return same


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> 1) ^ np.where(table & 1, np.uint32(0xEDB88320), np.uint32(0))
    return table


_CRC = _crc_table()


def crc32s(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """crc32 of byte ranges, a byte of all short ones at a time."""
    short = np.flatnonzero(sizes < LANES)
    short = short[np.argsort(-sizes[short], kind="stable")]
    at, size = starts[short], sizes[short]
    h = np.full(len(short), 0xFFFFFFFF, dtype=np.uint32)
    for k in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -k, side="left"))  # ranges of more than k bytes come first
        h[:n] = _CRC[(h[:n] ^ data[at[:n] + k]) & 255] ^ (h[:n] >> 8)
    out = np.zeros(len(starts), dtype=np.int64)
    out[short] = h ^ np.uint32(0xFFFFFFFF)
    buffer = memoryview(data)
    for i in np.flatnonzero(sizes >= LANES).tolist():
        out[i] = crc32(buffer[starts[i] : starts[i] + sizes[i]])
    return out


@dataclass
class GramTable:
    """Distinct byte ranges in an open-addressed table of twice as many slots, a power of two."""

    data: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    buckets: int
    slot: np.ndarray = field(init=False)     # of every range
    bucket: np.ndarray = field(init=False)   # of every slot
    count: np.ndarray = field(init=False)    # of every slot

    def __post_init__(self) -> None:
        keys, n = xxhash64(self.data, self.starts, self.sizes), len(self.starts)
        room = 1 << max(3, (2 * n - 1).bit_length())
        owner = np.full(room, -1, dtype=np.int64)
        self.slot = np.zeros(n, dtype=np.int64)
        probe = (keys & np.uint64(room - 1)).astype(np.int64)
        left = np.arange(n)
        while len(left):
            at = probe[left]
            empty = owner[at] < 0
            owner[at[empty]] = left[empty]
            by = owner[at]
            same = (keys[by] == keys[left]) & (self.sizes[by] == self.sizes[left])
            check = np.flatnonzero(same & (by != left))
            same[check] = _same_bytes(self.data, self.starts[by[check]], self.starts[left[check]], self.sizes[left[check]])
            self.slot[left[same]] = at[same]
            left = left[~same]
            probe[left] = (probe[left] + 1) & (room - 1)
        used = np.flatnonzero(owner >= 0)
        self.bucket = np.zeros(room, dtype=np.int64)
        self.bucket[used] = crc32s(self.data, self.starts[owner[used]], self.sizes[owner[used]]) % self.buckets
        self.count = np.bincount(self.slot, minlength=room)


def grams(data: np.ndarray, offsets: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features of consecutive texts, text by text: padded bytes, starts, sizes, first feature per text (n + 1 long), words per text."""
    low = lowered(data)
    starts, ends, first = spans(_WORD[low], offsets)
    packed, _ = join_words(low, starts, ends, np.arange(len(starts)), first)
    size, words = ends - starts, np.diff(first)
    text = np.repeat(np.arange(len(words)), words)
    gap = np.ones(len(starts), dtype=np.int64)
    gap[first[1:][words > 0] - 1] = 0
    begin = np.cumsum(size + gap) - (size + gap)
    at, sizes, of = [], [], []
    for k in range(longest):
        n = max(len(starts) - k, 0)
        whole = text[:n] == text[k:]
        at.append(begin[:n][whole])
        sizes.append((begin[k:] + size[k:] - begin[:n])[whole])
        of.append(text[:n][whole])
    at, sizes, of = np.concatenate(at), np.concatenate(sizes), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    bounds = np.searchsorted(of[order], np.arange(len(words) + 1))
    return np.append(packed, np.zeros(8, dtype=np.uint8)), at[order], sizes[order], bounds, words


def bucket_counts(docs: DataFrame, text_col: str = "text", shape: Grams = Grams()) -> DataFrame:
    """(bucket, n): features per bucket over all texts; one row per bucket and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape.buckets, dtype=np.int64)
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                table = GramTable(*grams(data, offsets, shape.longest)[:3], shape.buckets)
                total += np.bincount(table.bucket, weights=table.count, minlength=shape.buckets).astype(np.int64)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["bucket", "n"])

    rows = docs.select(F.col(text_col).alias("text")).where(F.col("text").isNotNull()).mapInArrow(run, "bucket long, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, shape: Grams = Grams()) -> np.ndarray:
    """Per bucket, the floor of 1000 times the logarithm of its smoothed share in the target over that in the raw corpus."""
    def counts(df: DataFrame) -> np.ndarray:  # one row per bucket
        out = np.zeros(shape.buckets, dtype=np.int64)
        for r in df.collect():
            out[r["bucket"]] = r["n"]
        return out

    s, t = counts(raw), counts(target)
    all_s, all_t = float(s.sum()), float(t.sum())
    return np.array([
        math.floor(1000 * math.log((b + 1.0) * (all_s + shape.buckets) / ((a + 1.0) * (all_t + shape.buckets)))) for a, b in zip(s.tolist(), t.tolist())
    ], dtype=np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", shape: Grams = Grams()) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every text; the weight is the floored mean gain of its features, 0 without any."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = StructType([rows.schema["doc_id"], *[StructField(c, LongType()) for c in ("n_words", "n_features", "weight")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_slices(batch.column(1)):
                packed, at, sizes, bounds, words = grams(data, offsets, shape.longest)
                table = GramTable(packed, at, sizes, shape.buckets)
                summed = np.append(0, np.cumsum(gain[table.bucket][table.slot]))
                n = np.diff(bounds)
                weight = (summed[bounds[1:]] - summed[bounds[:-1]]) // np.maximum(n, 1)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(x) for x in (words, n, weight))], schema.names)

    return rows.mapInArrow(run, schema)


def gumbel(key: Column) -> Column:
    """1000 times a Gumbel variate, floored, from the first 32 bits of the key's sha256."""
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000.0)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
    target_col: str = "text", shape: Grams = Grams(),
) -> DataFrame:
    """Every document's (doc_id, n_features, weight, score, rank); the rank is null where it is not drawn.

    Of the documents with ``least_words`` words or more, the floor of ``percent`` per cent with the highest scores are drawn.
    """
    if not 0 <= percent <= 100:
        raise ValueError("percent must be between 0 and 100")
    gain = gains(bucket_counts(docs, text_col, shape), bucket_counts(target, target_col, shape), shape)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    scored = stored(weigh(docs, gain, id_col, text_col, shape).withColumn("score", F.col("weight") + gumbel(key)), "target-scores")
    able = F.col("n_words") >= least_words
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    placed = scored.where(able).repartitionByRange(*order).sortWithinPartitions(*order)
    # the number holds the partition in its upper bits and the place within it in the lower 33
    placed = stored(placed.withColumn("place", F.monotonically_increasing_id()), "target-order")
    part = F.shiftrightunsigned("place", 33).alias("part")
    parts = placed.groupBy(part).agg(F.count("*").alias("n"))  # one row per partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("able"))
    ranked = placed.withColumn("part", part).join(F.broadcast(parts), "part").withColumn(
        "rank", F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    )
    drawn = F.when(F.col("rank") <= F.call_function("div", F.col("able") * percent, F.lit(100)), F.col("rank"))
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, drawn.alias("rank")).unionAll(scored.where(~able).select(*columns, F.lit(None).cast("long").alias("rank")))


# The same in DuckDB, which has no crc32: a table of 256 entries from the polynomial, then a byte at a time.
RESAMPLE_SQL = r"""
WITH crc_table AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::UBIGINT, range(8)::UBIGINT[]), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END) AS c
    FROM range(256) AS r(i))
), texts AS (
  SELECT 'raw' AS side, row_number() OVER () AS rid, doc_id, text FROM documents
  UNION ALL SELECT 'target', row_number() OVER (), NULL, text FROM benchmark
), worded AS (
  SELECT side, rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM texts
), grams AS (
  SELECT side, rid, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS gram FROM worded
), counted AS MATERIALIZED (
  SELECT side, rid, gram, count(*) AS n FROM grams GROUP BY ALL
), buckets AS MATERIALIZED (
  SELECT gram, xor(list_reduce(
      list_prepend(4294967295::UBIGINT, list_transform(range(0, length(h) // 2), lambda j: ('0x' || substr(h, 2 * j + 1, 2))::UBIGINT)),
      lambda c, b: xor(c // 256, t[(xor(c, b) % 256 + 1)::BIGINT])), 4294967295::UBIGINT) % 10000 AS bucket
  FROM (SELECT DISTINCT gram, hex(gram) AS h FROM counted), crc_table
), sides AS (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 'raw'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (WHERE side = 'target'), 0)::DOUBLE AS t
  FROM counted JOIN buckets USING (gram) GROUP BY bucket
), gain AS (
  SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM sides) + 10000) / ((s + 1) * ((SELECT sum(t) FROM sides) + 10000)))) AS gain FROM sides
), weights AS (
  SELECT rid, sum(n) AS n_features, floor(sum(n * gain) / sum(n)) AS weight
  FROM counted JOIN buckets USING (gram) JOIN gain USING (bucket) WHERE side = 'raw' GROUP BY rid
), scored AS (
  SELECT doc_id, len(words) >= 20 AS able, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || sha256('7:' || coalesce(doc_id::VARCHAR, ''))[1:8])::UBIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM worded LEFT JOIN weights USING (rid) WHERE side = 'raw'
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER (PARTITION BY able) AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 25 * n // 100 THEN place END::BIGINT AS rank FROM ranked
"""
