"""Packed token-id rows: best-fit decreasing with a segment tree over residual capacities.

A task packs its documents in blocks of ``block_tokens`` ids, so its memory is
bounded by the block and the longest document, nothing is shuffled, and a lost
executor costs only the tasks it ran. Pieces of ``row`` ids fill rows of their own as
they come; the rest of a block is packed together. A block leaves
at most a few rows part-filled beyond what packing the whole corpus at once would.

A document is its ids closed by the end id; only those longer than a row are cut, and
``doc_ids``, ``pieces`` and ``cu_seqlens`` give every id back in place. Null
texts are empty, repeated and null document ids are rows of their own, an empty
table gives an empty result, and other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from quarry.llm.tokens import cuts, encoded_batches, id_and_text

PAD_ID = 0


class CapacityTree:
    """Open rows by residual capacity; a segment tree over 0..size finds the smallest residual that is large enough."""

    def __init__(self, size: int) -> None:
        self.width = 1 << size.bit_length()
        self.count = [0] * (2 * self.width)
        self.rows: list[list[int]] = [[] for _ in range(self.width)]

    def add(self, residual: int, row: int) -> None:
        self.rows[residual].append(row)
        node = self.width + residual
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(residual, row) of a row with the smallest residual of at least ``need``; it leaves the tree."""
        node = self.width + need
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):  # up to where a right sibling has rows
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.width:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        residual = node - self.width
        row = self.rows[residual].pop()
        while node:
            self.count[node] -= 1
            node >>= 1
        return residual, row


def best_fit_decreasing(lengths: list[int], size: int) -> list[list[int]]:
    """Indices of ``lengths`` per row, longest first; each goes where it leaves the least room."""
    tree, rows = CapacityTree(size), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[i])
        if found is None:
            rows.append([])
            found = (size, len(rows) - 1)
        residual, row = found
        rows[row].append(i)
        tree.add(residual - lengths[i], row)
    return rows


def pack_rows(
    docs: DataFrame, tokenizer_path: str, row: int = 1024, id_col: str = "doc_id", text_col: str = "text",
    block_tokens: int = 1 << 21, pad_id: int = PAD_ID,
) -> DataFrame:
    """One row per packed sequence.

    sequence_id: long; n_tokens: ids before the padding; ids: the matrix row,
    ``row`` little-endian unsigned 32-bit ids; cu_seqlens: cumulative segment lengths
    from 0; doc_ids, pieces, starts: per segment, its document, number and first id's place in the document;
    position_resets: the places where position ids begin again at 0 (every segment, and the padding).
    """
    id_type = dict(docs.dtypes)[id_col]
    schema = (
        f"sequence_id long, n_tokens int, ids binary, cu_seqlens array<int>, doc_ids array<{id_type}>, "
        "pieces array<int>, starts array<long>, position_resets array<int>"
    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 33
        block: list[tuple] = []
        held = 0

        def emit(rows: list[list[tuple]]) -> pa.RecordBatch:
            nonlocal number
            out: list[tuple] = []
            for segments in rows:
                ids = np.full(row, pad_id, dtype="<u4")
                ends = np.cumsum([0, *(len(s[3]) for s in segments)])
                for s, a, b in zip(segments, ends, ends[1:]):
                    ids[a:b] = s[3]
                n = int(ends[-1])
                resets = ends[:-1].tolist() + ([n] if n < row else [])
                out.append((number, n, ids.tobytes(), ends.tolist(), [s[0] for s in segments], [s[1] for s in segments], [s[2] for s in segments], resets))
                number += 1
            cols = list(zip(*out))
            ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
            types = [pa.int64(), pa.int32(), pa.binary(), ints, None, ints, longs, ints]
            names = ["sequence_id", "n_tokens", "ids", "cu_seqlens", "doc_ids", "pieces", "starts", "position_resets"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        def flush() -> Iterator[pa.RecordBatch]:
            rows = [[block[i] for i in r] for r in best_fit_decreasing([len(s[3]) for s in block], row)]
            for at in range(0, len(rows), 1024):
                yield emit(rows[at : at + 1024])

        for doc_ids, arrays in encoded_batches(batches, tokenizer_path):
            full: list[list[tuple]] = []
            for d, a in zip(doc_ids, arrays):
                for k, (s, n) in enumerate(cuts(len(a), row)):
                    if n == row:
                        full.append([(d, k, s, a[s : s + n])])
                    else:
                        block.append((d, k, s, a[s : s + n].copy()))
                        held += n
            for at in range(0, len(full), 1024):
                yield emit(full[at : at + 1024])
            if held >= block_tokens:
                yield from flush()
                block, held = [], 0
        if block:
            yield from flush()

    return id_and_text(docs, id_col, text_col).mapInArrow(packed, schema)
