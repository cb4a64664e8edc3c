"""Passages that recur across documents, located by sharded Aho-Corasick automata.

A window is ``Passages.words`` consecutive words of one document. A window recurs
in a document when its word sequence also starts in a document with a smaller
id; every word that such a window covers is removed.

1. **Confirm.** Every window has an anchor: the least hash of its runs of ``gram`` words. Equal
   windows have equal anchors, and neighbouring windows mostly share one, so about a fifth as many
   (anchor, document) rows as windows are counted. Anchors of one document only cannot recur and go.
2. **Cut.** The documents meet their recurring anchors; the windows of one anchor that follow each other make a
   phrase. Phrases are dealt by anchor, those of an anchor that more than ``hot`` rows hold by window, each window a
   phrase of its own, so that no anchor is a hot key. Equal phrases become one row with their least and largest id.
3. **Compile.** Phrases are dealt to shards of about ``shard_bytes`` of text. A shard's words
   become pairs of code points; its windows of more than one document, joined where neighbours have one smallest document, become the
   patterns of automata of the size of ``patterns`` windows each (pyahocorasick), a pattern carrying that document.
4. **Stream.** Every phrase of the shard, from whichever documents, runs through the shard's automata, which name
   the smallest document for every window found. The places of the phrases in the documents are joined to that.

All windows of an anchor (or equal windows of a hot one) are in one shard, so no automaton needs to see another shard's
documents, and a document's text is read by the automata only where something of it may recur. Matching is by text;
64-bit hashes only choose candidates, and equal windows always have equal hashes, so none is lost.

Bounds: a slice of texts (1 MB, or one longer text), a shard's phrases (``shard_bytes``, or a longer phrase) and one
automaton are in memory at a time; nothing reaches the driver but the number of bytes of the phrases.

Defined results: a null or empty text has no words and stays empty; documents shorter than a window keep all words; rows
with one id do not remove each other's words; a row without an id neither removes nor loses any; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from quarry.llm.common import _BASE, _SPACE, mix, released, stored, text_slices
from quarry.llm.word_bytes import as_strings, exact_hashes, join_words, ranges, spans

DIGIT = 128


@dataclass(frozen=True)
class Passages:
    """What recurs (windows of ``words`` words), how it is looked for, and the bounds of a shard and an automaton."""

    words: int = 13
    gram: int = 5
    hot: int = 2000
    shard_bytes: int = 1 << 20
    patterns: int = 25_000

    def __post_init__(self) -> None:
        if not 0 < self.gram <= self.words:
            raise ValueError("gram must be between 1 and words")


def _rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` neighbouring words."""
    n = max(len(hashes) - width + 1, 0)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        out = out * np.uint64(_BASE) + hashes[k : k + n]
    return mix(out)


def window_anchors(hashes: np.ndarray, first: np.ndarray, shape: Passages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of consecutive texts: first word, text, and anchor."""
    grams = _rolled(hashes, shape.gram)
    n = max(len(hashes) - shape.words + 1, 0)
    anchor = grams[:n].copy()
    for k in range(1, shape.words - shape.gram + 1):
        np.minimum(anchor, grams[k : k + n], out=anchor)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(text[:n] == text[shape.words - 1 :]) if n else np.zeros(0, dtype=np.int64)
    return at, text[at], anchor[at].view(np.int64)


def anchors(rows: DataFrame, shape: Passages) -> DataFrame:
    """(anchor, doc_id): the anchors of every text of (doc_id, text), once for windows next to each other."""
    schema = StructType.fromDDL("anchor long").add(rows.schema["doc_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_slices(batch.column("text")):
                starts, ends, first = spans(~_SPACE[data], offsets)
                _, text, anchor = window_anchors(exact_hashes(data, starts, ends), first, shape)
                new = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))) if len(text) else text
                for low in range(0, len(new), 100_000):
                    part = new[low : low + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array(anchor[part]), batch.column("doc_id").take(pa.array(text[part] + a))], schema.names)

    return rows.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).mapInArrow(run, schema)


def phrases(marked: DataFrame, shape: Passages) -> DataFrame:
    """(route, phrase, doc_id, tkey, place) of every phrase of (doc_id, tkey, text, marks, hot).

    ``marks`` are the document's recurring anchors, ``hot`` those of them that are dealt by window. ``place`` is the phrase's first word.
    """
    schema = StructType.fromDDL("route long, phrase string").add(marked.schema["doc_id"]).add(marked.schema["tkey"]).add("place", IntegerType())

    def chosen(text: np.ndarray, anchor: np.ndarray, lists: pa.Array) -> np.ndarray:
        """Which windows have an anchor of their text's list."""
        owner, listed = pc.list_parent_indices(lists).to_numpy(), pc.list_flatten(lists).to_numpy()
        keys = mix(owner.astype(np.uint64) + np.uint64(1)) ^ listed.view(np.uint64)  # a stray match only adds a candidate
        return np.isin(mix(text.astype(np.uint64) + np.uint64(1)) ^ anchor.view(np.uint64), keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_slices(batch.column("text")):
                part = batch.slice(a, b - a)
                starts, ends, first = spans(~_SPACE[data], offsets)
                hashes = exact_hashes(data, starts, ends)
                at, text, anchor = window_anchors(hashes, first, shape)
                found = np.flatnonzero(chosen(text, anchor, part.column("marks")))
                at, text, anchor = at[found], text[found], anchor[found]
                if not len(at):
                    continue
                single = chosen(text, anchor, part.column("hot"))
                new = np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (at[1:] != at[:-1] + 1)) | single
                head = np.flatnonzero(new)
                windows = np.diff(np.append(head, len(at)))
                begin, owner = at[head], text[head]
                route = np.where(single[head], _rolled(hashes, shape.words).view(np.int64)[begin], anchor[head])
                size = windows + shape.words - 1
                for low in range(0, len(head), 20_000):
                    cut = slice(low, low + 20_000)
                    words = ranges(begin[cut], size[cut])
                    texts = as_strings(*join_words(data, starts, ends, words, np.append(0, np.cumsum(size[cut]))))
                    rows = pa.array(owner[cut])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(route[cut]), texts.cast(pa.string()), part.column("doc_id").take(rows), part.column("tkey").take(rows),
                            pa.array((begin - first[owner])[cut], pa.int32()),
                        ], schema.names,
                    )

    return marked.mapInArrow(run, schema)


def first_documents(texts: pa.Array, least: pa.Array, most: pa.Array, shape: Passages) -> pa.Array:
    """For every phrase, the smallest document that each of its windows starts in; null where no other document has the window.

    ``least`` and ``most`` are the smallest and the largest document that hold the phrase as a whole. Windows of one phrase in one
    document are no patterns; the others, joined where they follow each other in a phrase and have one smallest document, become automata,
    through which all phrases are streamed.
    """
    width = shape.words
    words = pc.split_pattern(texts, " ")
    sizes = np.diff(words.offsets.to_numpy())
    coded = words.flatten().dictionary_encode()
    if len(coded.dictionary) > 0x10FFFF - 2 * DIGIT:
        raise ValueError("a shard holds more distinct words than there are code points; lower shard_bytes")
    # every word two code points of different ranges, as automata search a node's followers one by one; every phrase closed by a 0
    number = coded.indices.to_numpy().astype(np.int64)
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    points = np.zeros((len(coded) + len(sizes), 2), dtype="<u4")
    points[ranges(begin, sizes)] = np.column_stack([2 * DIGIT + number // DIGIT, DIGIT + number % DIGIT])
    stream = points.tobytes().decode("utf-32-le", "surrogatepass")
    ids = pc.unique(pa.concat_arrays([least, most]))
    ids = ids.take(pc.sort_indices(ids))
    low, high = (pc.index_in(x, ids).to_numpy() for x in (least, most))
    # windows by number, with their smallest and largest document
    windows = sizes - width + 1
    places = ranges(begin, windows)
    owner = np.repeat(np.arange(len(sizes)), windows)
    numbers: dict[str, int] = {}
    window = np.array([numbers.setdefault(stream[2 * k : 2 * (k + width)], len(numbers)) for k in places.tolist()], dtype=np.int64)
    first, last = np.full(len(numbers), len(ids), dtype=np.int64), np.full(len(numbers), -1, dtype=np.int64)
    np.minimum.at(first, window, low[owner])
    np.maximum.at(last, window, high[owner])
    # neighbouring windows with one smallest document are one pattern, of at most as many windows as one run of ``gram`` words is in:
    # so few lengths end at one place, also in texts that repeat themselves
    most_windows = width - shape.gram + 1
    again = np.flatnonzero(first[window] < last[window])
    at, of, smallest = places[again], owner[again], first[window[again]]
    new = np.append(True, (at[1:] != at[:-1] + 1) | (of[1:] != of[:-1]) | (smallest[1:] != smallest[:-1]))[: len(at)]
    head = np.flatnonzero(new)
    within = np.arange(len(at)) - np.repeat(head, np.diff(np.append(head, len(at))))
    head = np.flatnonzero(within % most_windows == 0)
    runs: dict[str, tuple[int, int]] = {}
    for k, n, f in zip(at[head].tolist(), np.diff(np.append(head, len(at))).tolist(), smallest[head].tolist()):
        runs[stream[2 * k : 2 * (k + n + width - 1)]] = n, f
    found = np.full(len(points), -1, dtype=np.int64)
    patterns, values = list(runs), np.array(list(runs.values()), dtype=np.int64).reshape(-1, 2)
    # an automaton holds as many code points as ``shape.patterns`` windows
    part = np.cumsum([len(x) for x in patterns]) // (2 * width * shape.patterns)
    for cut in np.split(np.arange(len(patterns)), np.flatnonzero(np.diff(part)) + 1):
        if not len(cut):
            continue
        machine = ahocorasick.Automaton()
        for k in cut.tolist():
            machine.add_word(patterns[k], k)
        machine.make_automaton()
        hits = np.fromiter((x for hit in machine.iter(stream) for x in hit), dtype=np.int64).reshape(-1, 2)
        size, value = values[hits[:, 1]].T
        start = (hits[:, 0] + 1) // 2 - (size + width - 1)
        for n in range(1, most_windows + 1):
            of_size = size == n
            for k in range(n):
                found[start[of_size] + k] = value[of_size]
    firsts = found[places]
    offsets = np.append(0, np.cumsum(windows))
    return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), ids.take(pa.array(firsts, mask=firsts < 0)))


def located(found: DataFrame, shape: Passages) -> DataFrame:
    """(doc_id, tkey, starts): the first words of each document's windows that also start in a smaller one. ``found`` is stored, and released."""
    distinct = found.groupBy("route", "phrase").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    distinct = stored(distinct.withColumn("pkey", F.xxhash64("phrase")), "passage-phrases", "zstd")
    total = distinct.agg(F.sum(F.octet_length("phrase"))).first()[0] or 0
    shards = max(1, -(-total // shape.shard_bytes))
    firsts_type = f"route long, pkey long, firsts array<{distinct.schema['least'].dataType.simpleString()}>"

    def shard(table: pa.Table) -> pa.Table:
        least, most, phrase = (table[c].combine_chunks() for c in ("least", "most", "phrase"))
        firsts = first_documents(phrase, least, most, shape)
        later = pc.fill_null(pc.less(pc.list_flatten(firsts), most.take(pc.list_parent_indices(firsts))), False).to_numpy(zero_copy_only=False)
        some = pa.array(np.add.reduceat(later.astype(np.int64), firsts.offsets.to_numpy()[:-1]) > 0)
        columns = [table["route"], table["pkey"], firsts.cast(pa.list_(least.type))]
        return pa.table(columns, ["route", "pkey", "firsts"]).filter(some)

    dealt = distinct.withColumn("shard", F.pmod(F.xxhash64("route"), F.lit(int(shards))))
    firsts = stored(dealt.groupBy("shard").applyInArrow(shard, firsts_type), "passage-firsts")
    placed = stored(found.select("route", F.xxhash64("phrase").alias("pkey"), "doc_id", "tkey", "place"), "passage-places")
    released(distinct, found)
    places = placed.join(firsts, ["route", "pkey"])
    later = F.filter(F.transform("firsts", lambda f, i: F.when(f < F.col("doc_id"), F.col("place") + i)), lambda x: x.isNotNull())
    places = places.select("doc_id", "tkey", later.alias("starts")).where(F.size("starts") > 0)
    starts = stored(places.groupBy("doc_id", "tkey").agg(F.flatten(F.collect_list("starts")).alias("starts")), "passage-starts")
    released(firsts, placed)
    return starts


def drop_recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shape: Passages = Passages()) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, removed) of every row.

    ``kept``: the remaining words joined by one space; ``removed``: (start, end) word ranges of what went, end exclusive.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # at least two rows hold a recurring anchor; ``n`` rows decide how its phrases are dealt
    held = stored(anchors(rows, shape), "passage-held")  # read twice; made of every text
    recurring = held.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n"))
    recurring = stored(recurring.where("low < high").select("anchor", (F.col("n") > shape.hot).alias("hot")), "passage-anchors")
    marks = held.join(recurring, "anchor").groupBy("doc_id").agg(
        F.collect_set("anchor").alias("marks"), F.collect_set(F.when(F.col("hot"), F.col("anchor"))).alias("hot")
    )
    keyed = rows.withColumn("tkey", F.xxhash64("text"))
    marks = stored(marks, "passage-marks")
    released(recurring, held)
    found = stored(phrases(keyed.where("text IS NOT NULL").join(marks, "doc_id"), shape), "passage-found", "zstd")
    released(marks)
    spans_of = located(found, shape)
    schema = StructType([rows.schema["doc_id"], *StructType.fromDDL(
        "n_words long, n_removed long, kept string, removed array<struct<start: bigint, end: bigint>>").fields])
    entry = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    width = shape.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_slices(batch.column("text")):
                part = batch.slice(a, b - a)
                starts, ends, first = spans(~_SPACE[data], offsets)
                lists = part.column("starts")
                windows = pc.list_flatten(lists).to_numpy() + first[pc.list_parent_indices(lists).to_numpy()]
                change = np.zeros(len(starts) + 1, dtype=np.int64)
                np.add.at(change, windows, 1)
                np.add.at(change, windows + width, -1)
                gone = np.cumsum(change[:-1]) > 0
                text = np.repeat(np.arange(b - a), np.diff(first))
                before = np.append(False, gone[:-1] & (text[1:] == text[:-1])) if len(gone) else gone
                after = np.append(gone[1:] & (text[1:] == text[:-1]), False) if len(gone) else gone
                low, high = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after) + 1
                spans_ = pa.LargeListArray.from_arrays(
                    pa.array(np.searchsorted(low, first), pa.int64()),
                    pa.StructArray.from_arrays([pa.array(low - first[text[low]]), pa.array(high - first[text[low]])], fields=list(entry)),
                )
                left = np.append(0, np.cumsum(~gone))[first]
                kept = as_strings(*join_words(data, starts, ends, np.flatnonzero(~gone), left))
                n = np.diff(first)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(n - np.diff(left), pa.int64()), kept.cast(pa.string()), spans_.cast(pa.list_(entry))],
                    schema.names,
                )

    return keyed.join(spans_of, ["doc_id", "tkey"], "left").select("doc_id", "text", "starts").mapInArrow(run, schema)


# Windows as strings: words hold no blanks, so equal strings are equal word sequences.
RECURRING_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT rid, doc_id, i, array_to_string(words[i:i + 12], ' ') AS w
  FROM (SELECT rid, doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM docs WHERE len(words) >= 13)
), firsts AS (
  SELECT w, min(doc_id) AS low FROM windows GROUP BY w
), gone AS (
  SELECT DISTINCT rid, i + k AS pos FROM windows JOIN firsts USING (w), range(13) AS r(k) WHERE low < doc_id
), listed AS (
  SELECT rid, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM docs
), kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY pos) AS kept, count(*) AS n FROM listed ANTI JOIN gone USING (rid, pos) GROUP BY rid
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (rid)
"""
