"""What the operators share: intermediate tables, stable row hashes, vectorised words."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Largest number of text bytes that one numpy pass handles; a longer single text is one pass of its own.
SLICE_BYTES = 1 << 20
# How a step that is stored runs: bounded Arrow batches, shuffle files removed at its end.
STEP_CONF = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or a fresh one in an unconfigured local session."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="quarry-llm-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back, so that later steps never recompute it.

    The folder belongs to the caller's ``spark.checkpoint.dir`` and is cleaned up with it; ``released`` removes it earlier. While the
    step runs, Arrow batches hold a bounded number of bytes, and what it shuffled goes as soon as it is written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = {k: spark.conf.get(k, None) for k in STEP_CONF}
    try:
        for k, v in STEP_CONF.items():
            spark.conf.set(k, v)
        df.write.option("compression", codec).parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def released(*frames: DataFrame) -> None:
    """Remove the files of tables from ``stored`` that no later step reads, in whichever file system they lie."""
    for df in frames:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def give_back() -> None:
    """Freed memory of this process goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, a function for ``mapInArrow``, giving freed memory back to the system when its task ends.

    Python workers live on between stages, and what they hold is missing to the next stage of the same executor.
    """

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return out


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for w in wanted:
        while w.lower() in taken:
            w = f"_{w}"
        taken.add(w.lower())
        out.append(w)
    return out


# ---- vectorised words over Arrow text columns ------------------------------

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE_BYTES)
        for key, b in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            np.multiply.accumulate(p, out=p)
            _POWERS[key] = p
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut an Arrow text column into row ranges of about ``limit`` bytes: (first row, end row, bytes, offsets).

    Bytes and offsets are those of the rows' UTF-8 texts; a null text is empty.
    """
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64, count=n + 1, offset=8 * column.offset)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end, raw[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of consecutive texts: starts, ends, and per text the index of its first word (n + 1 long)."""
    solid = ~_SPACE[data]
    before = np.empty_like(solid)
    after = np.empty_like(solid)
    if len(solid):
        before[1:], after[:-1] = solid[:-1], solid[1:]
        before[0] = after[-1] = False
        edge = offsets[:-1][np.diff(offsets) > 0]
        before[edge] = False
        after[edge[edge > 0] - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words, A-Z taken as a-z: a polynomial in the bytes, scrambled with the length."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    poly = (sums[ends] - sums[starts]) * down[starts]
    return mix(poly + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z taken as a-z."""
    return _LOWER[data]
