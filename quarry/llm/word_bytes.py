"""Words of Arrow text slices as byte ranges: found by a byte class, joined again, hashed as they are."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from quarry.llm.common import SLICE_BYTES, _powers, mix


def spans(solid: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of solid bytes within consecutive texts: starts, ends, and per text the index of its first run (n + 1 long)."""
    before, after = np.zeros_like(solid), np.zeros_like(solid)
    if len(solid):
        before[1:], after[:-1] = solid[:-1], solid[1:]
        edge = offsets[:-1][np.diff(offsets) > 0]
        before[edge] = False
        after[edge[edge > 0] - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers ``first[i] .. first[i] + size[i] - 1``, one range after the other."""
    total = int(size.sum())
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(total)


def join_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts made of ``words[bounds[i]:bounds[i + 1]]`` joined by one space: bytes and offsets.

    Index arrays are built for blocks of about ``SLICE_BYTES``, whatever the length of a text.
    """
    size = ends[words] - starts[words]
    gap = np.ones(len(words), dtype=np.int64)
    gap[bounds[1:][np.diff(bounds) > 0] - 1] = 0
    at = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum(size + gap, out=at[1:])
    out = np.full(at[-1], 0x20, dtype=np.uint8)
    low = 0
    while low < len(words):
        high = max(low + 1, int(np.searchsorted(at, at[low] + SLICE_BYTES, side="right")) - 1)
        if high == low + 1:
            s = starts[words[low]]
            out[at[low] : at[low] + size[low]] = data[s : s + size[low]]
        else:
            out[ranges(at[low:high], size[low:high])] = data[ranges(starts[words[low:high]], size[low:high])]
        low = high
    return out, at[bounds]


def as_strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Arrow strings over a byte buffer."""
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, dtype=np.int64)), pa.py_buffer(data))


def exact_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, letters told apart by case: a polynomial in the bytes, scrambled with the length."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal numbers for equal words and different ones for different words."""
    if not len(starts):
        return np.zeros(0, dtype=np.int64)
    packed, offsets = join_words(data, starts, ends, np.arange(len(starts)), np.arange(len(starts) + 1))
    return as_strings(packed, offsets).dictionary_encode().indices.to_numpy().astype(np.int64)
