"""Token ids of whole texts inside Spark tasks.

The byte-level BPE vocabulary is a public file whose path is a parameter. Its
rank file holds the same vocabulary for a faster encoder; the tokens added to the
vocabulary are read from the ``.json`` beside it, and stand for themselves wherever
a text holds them. Its splitter gives up on runs of hundreds of thousands of blanks or letters, so a text with a run of
``LONG_RUN`` characters goes through the ``.json`` tokenizer itself. A test holds both to the same ids.
"""

from __future__ import annotations

import base64
import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END_ID = 2  # closes every document
LONG_RUN = 20_000
_LONG = re.compile(r"\s{%d}|\S{%d}" % (LONG_RUN, LONG_RUN))


@cache
def _encoder(path: str) -> Callable[[str], np.ndarray]:
    """text -> uint32 ids, for a ``.tiktoken`` rank file or a ``.json`` tokenizer; one per Python worker."""
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        return lambda s: np.array(t.encode(s, add_special_tokens=False).ids, dtype="<u4")
    by_rank, whole = _rank_encoder(path), os.path.splitext(path)[0] + ".json"
    return lambda s: _encoder(whole)(s) if len(s) >= LONG_RUN and _LONG.search(s) else by_rank(s)


def _rank_encoder(path: str) -> Callable[[str], np.ndarray]:
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    e = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    added = _added(os.path.splitext(path)[0] + ".json")
    if not added:
        return lambda s: np.frombuffer(array("I", e.encode_ordinary(s)), dtype="<u4")
    cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")

    def ids(s: str) -> np.ndarray:
        out = array("I")
        for k, part in enumerate(cut.split(s)):
            out.extend([added[part]] if k % 2 else e.encode_ordinary(part))
        return np.frombuffer(out, dtype="<u4")

    return ids


def _added(path: str) -> dict[str, int]:
    """The added tokens of a ``.json`` tokenizer and their ids; those matched by other than their plain text are refused."""
    with open(path, encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    for t in tokens:
        if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] and not t["special"]:
            raise ValueError(f"added token {t['content']!r} is not matched by its text alone")
    return {t["content"]: t["id"] for t in tokens}


def default_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def encode(path: str, text: str | None, end_id: int = END_ID) -> np.ndarray:
    """Ids of one whole text, closed by ``end_id``; a null text is empty."""
    return np.append(_encoder(path)(text or ""), np.uint32(end_id)).astype("<u4", copy=False)


def cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: all of ``size`` but for the first, which holds the remainder."""
    first = n % size or min(n, size)
    return [(0, first)] + [(s, size) for s in range(first, n, size)]


def encoded_batches(
    batches: Iterator[pa.RecordBatch], path: str, rows: int = 256
) -> Iterator[tuple[list, list[np.ndarray]]]:
    """(doc ids, id arrays) of up to ``rows`` documents of two-column batches (doc_id, text)."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part.column(0).to_pylist(), [encode(path, t) for t in part.column(1).to_pylist()]


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an encoder needs, under fixed names whatever else ``docs`` holds."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
