"""Benchmark overlaps by spaced seeds, in DataFrame operations only.

Words are the runs of letters and digits of the lower-cased text. A mask such as
``1101001101`` is laid on every word position; the words under its ones are hashed
and those under its zeros ignored, so a seed still matches when an ignored word
was substituted. Document seeds are joined to the benchmark items' seeds. Each hit fixes an
alignment of item and document. Of the hits of one alignment one is kept, with the document's words along the item only;
of these the words equal in place are counted,
and the overlap holds if some ``window`` consecutive item words (all words of a
shorter item) have at least ``share`` of them equal.

No allowed substitution escapes: the masks leave none of its patterns without a seed.
Items shorter than the window have masks of their own, by length; items of
under ``least`` words match nothing. Null and empty texts match nothing, rows
with equal ids (or null ids) count as one document, empty tables give an empty result, and of the
inputs' columns only id and text are looked at.

The seeds of the benchmark are broadcast while there are at most ``broadcast_seeds``
of them; the documents are then read once and only hits leave a task. Beyond that, the documents' seeds of marked slots are joined to
them by a shuffle, and the documents with hits are read again. A document's hits are many where it repeats an item or items repeat: generated code holds all
rows made of one input row until the last, so no hit may leave it with the document's words; the aggregate that keeps one hit of
an alignment takes them in as they come, and spills.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stored

BROADCAST_IDS = 500_000  # ids of documents that overlap an item, 8 bytes each; beyond it they are joined by a shuffle
MOST_BITS = 26           # of a table that marks seeds which are too many to broadcast: 8 MB

# Fixed values, by enumeration: wherever the substitutions allowed in 13 words fall, some mask misses them all.
MASKS = ("111011", "1100001011", "110111")  # weight 5
# The same for items of 5 to 12 words.
SHORT_MASKS = {
    5: ("111", "1101"), 6: ("1111", "11011"), 7: ("11111", "111011", "110111"), 8: ("11011", "1111", "1100011"),
    9: ("111011", "1001111", "11010011", "111101"), 10: ("111011", "11010011", "11111"), 11: ("1101011", "1110011"),
    12: ("111011", "110100011", "11001011", "110111"),
}


@dataclass(frozen=True)
class Overlap:
    """What counts as an overlap, and how many benchmark seeds may be broadcast (24 bytes each)."""

    masks: tuple[str, ...] = MASKS      # of items of ``window`` words and more
    window: int = 13
    share: float = 0.75
    least: int = 5
    broadcast_seeds: int = 500_000

    def masks_of(self, n: int) -> tuple[str, ...]:
        """The masks of an item of ``n`` words."""
        return self.masks if n >= self.window else SHORT_MASKS.get(n, ("1",))


def _words(text: Column) -> Column:
    """Hashes of the words of a text; none for a null one."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seed(words: Column, at: Column, mask: str) -> Column:
    """Hash of the words under the mask's ones from position ``at`` (from 0), null where the mask does not fit."""
    under = [F.get(words, at + i) for i, bit in enumerate(mask) if bit == "1"]
    return F.when(at + len(mask) <= F.size(words), F.xxhash64(F.lit(mask), *under))


def _along(words: Column, shift: Column, n: Column) -> Column:
    """The document's words along an item of ``n`` words; fewer where the document begins or ends inside the item."""
    return F.slice(words, F.greatest(shift, F.lit(0)) + 1, n + F.least(shift, F.lit(0)))


def _equal(along: Column, item: Column, shift: Column) -> Column:
    """Per item word, whether the document has it in place."""
    return F.transform(item, lambda w, j: F.coalesce(F.get(along, F.least(shift, F.lit(0)) + j) == w, F.lit(False)))


def _best(equal: Column, width: Column) -> Column:
    """The most equal words in ``width`` consecutive places."""
    ones = F.transform(equal, lambda e: e.cast("int"))
    return F.aggregate(
        F.sequence(F.lit(1), F.size(equal) - width + 1),
        F.lit(0),
        lambda most, i: F.greatest(most, F.aggregate(F.slice(ones, i, width), F.lit(0), lambda a, x: a + x)),
    )


def _marked(laid: DataFrame, seeds: DataFrame, count: int, *columns: str) -> DataFrame:
    """The rows of ``laid`` whose seed's slot is marked by one of the ``count`` seeds, sixteen slots a seed while they fit; spares the shuffle the rest."""
    slots = 1 << min(MOST_BITS, max(6, (16 * count).bit_length()))

    def word() -> Column:
        return F.shiftright(F.col("seed").bitwiseAND(F.lit(slots - 1)), 6).cast("int")

    def bit() -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.col("seed").bitwiseAND(F.lit(63)).cast("int"))

    marks = np.zeros(slots >> 6, dtype=np.int64)
    for r in seeds.groupBy(word().alias("word")).agg(F.bit_or(bit()).alias("bits")).toLocalIterator():
        marks[r["word"]] = r["bits"]
    row = pa.table({"marks": pa.ListArray.from_arrays(pa.array([0, len(marks)], pa.int32()), pa.array(marks))})
    marked = F.broadcast(laid.sparkSession.createDataFrame(row))
    # the table is looked up as the rows are made: none leaves generated code with it
    return laid.where("seed IS NOT NULL").crossJoin(marked).where(F.get("marks", word()).bitwiseAND(bit()) != 0).select(*columns)


def overlaps(
    docs: DataFrame, benchmark: DataFrame, how: Overlap = Overlap(), id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row per document and benchmark item that overlap.

    doc_id, item_id; doc_word, the document's word (from 0) where the item begins in the best alignment (negative
    if the document begins inside the item); equal_words, item words equal in place; item_words.
    """
    items = stored(
        benchmark.select(F.col(item_col).alias("item_id"), _words(F.col(item_text_col)).alias("item"))
        .where(F.size("item") >= how.least), "benchmark-words",
    )
    size = F.least(F.size("item"), F.lit(how.window))
    sizes = sorted(r["n"] for r in items.select(size.alias("n")).distinct().collect())  # at most window - least + 1
    masks = sorted({m for n in sizes for m in how.masks_of(n)}) or list(how.masks)
    seeds = (
        items.select("item_id", "item", F.explode(F.sequence(F.lit(0), F.size("item") - 1)).alias("item_at"))
        .select("item_id", F.size("item").alias("n"), "item_at", F.explode(F.array(*[
            F.when(size.isin([n for n in sizes if m in how.masks_of(n)]), _seed(F.col("item"), F.col("item_at"), m)) for m in masks
        ])).alias("seed")).where("seed IS NOT NULL")
    )
    seeds = stored(seeds, "benchmark-seeds")
    words = docs.select(F.col(id_col).alias("doc_id"), _words(F.col(text_col)).alias("words"))
    shift = (F.col("at") - F.col("item_at")).alias("shift")
    along = _along(F.col("words"), F.col("shift"), F.col("n")).alias("along")

    def laid(words: DataFrame) -> DataFrame:
        """``words`` with a row per position and mask; a text of too few words has none (as a filter, this would make the words twice)."""
        places = F.when(F.size("words") >= how.least, F.sequence(F.lit(0), F.size("words") - 1))
        return words.select("*", F.explode(places).alias("at")).select(
            "*", F.explode(F.array(*[_seed(F.col("words"), F.col("at"), m) for m in masks])).alias("seed"))

    if (count := seeds.count()) <= how.broadcast_seeds:
        hits = laid(words).join(F.broadcast(seeds), "seed").select("doc_id", "words", "item_id", "n", shift)
        placed = hits.select("doc_id", "item_id", "shift", along).distinct()
        aligned = placed.join(F.broadcast(items), "item_id")  # no more items than seeds
    else:
        words = words.withColumn("name", F.xxhash64("words"))  # tells texts of one id apart
        likely = _marked(laid(words), seeds, count, "doc_id", "name", "at", "seed")
        hits = stored(likely.join(seeds, "seed").select("doc_id", "name", "item_id", "n", shift).distinct(), "benchmark-hits")
        asked = hits.select("doc_id", "name").distinct()
        asked = (F.broadcast(asked) if asked.count() <= BROADCAST_IDS else asked).alias("b")
        same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.name") == F.col("b.name"))
        asked = words.alias("a").join(asked, same, "left_semi").groupBy("doc_id", "name").agg(F.any_value("words").alias("words"))  # equal rows count once
        placed = hits.alias("a").join(asked.alias("b"), same).select("a.doc_id", "item_id", "shift", along)
        aligned = placed.join(items, "item_id")
    width = F.least(F.lit(how.window), F.size("item"))
    checked = aligned.select(
        "doc_id", "item_id", "shift", F.size("item").alias("item_words"), width.alias("width"),
        _equal(F.col("along"), F.col("item"), F.col("shift")).alias("equal"),
    ).where(_best(F.col("equal"), F.col("width")) >= F.ceil(F.col("width") * how.share))
    found = checked.select(
        "doc_id", "item_id", "item_words", F.size(F.filter("equal", lambda e: e)).alias("equal_words"), "shift"
    )
    best = F.max(F.struct("equal_words", (-F.col("shift")).alias("back"), "item_words"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("best")).select(
        "doc_id", "item_id", (-F.col("best.back")).alias("doc_word"), "best.equal_words", "best.item_words"
    )


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, how: Overlap = Overlap(), id_col: str = "doc_id", text_col: str = "text",
    broadcast_ids: int = BROADCAST_IDS,
) -> DataFrame:
    """``docs`` without the documents that overlap an item; all columns as they are."""
    hit = stored(overlaps(docs, benchmark, how, id_col, text_col).select(F.col("doc_id").alias("hit")).distinct(), "benchmark-hits")
    hit = (F.broadcast(hit) if hit.count() <= broadcast_ids else hit).alias("b")
    kept = docs.alias("a").join(hit, F.col(f"a.{id_col}").eqNullSafe(F.col("b.hit")), "left_anti")
    return kept.select(*[F.col(f"a.`{c}`") for c in docs.columns])
