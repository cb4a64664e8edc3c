"""Text scoring by context-tree weighting over bytes, beside a smoothed unigram baseline.

A text is its lower-cased words (A-Z only) joined by single spaces and closed by a
line feed. Every byte is coded as eight binary decisions; each decision, in each
context of 0 to ``depth`` preceding bytes, has a Krichevsky-Trofimov estimate,
and the estimates of all depths are mixed by context-tree weighting: a node's weighted
probability is half its own estimate plus half the product of what its children give.

What is learnt covers all training texts: counts of (context, byte) and of words
are partial sums per task, then summed by key. Every context is a node, however rare. The weighting runs
level by level over stored tables of one row per context and decision: a group-by
from the deepest contexts to the root, then a join from the root to the deepest.
The texts to be scored bring their (context, byte) pairs along with no count, which changes no estimate,
so that every pair of any text has its log-probability in one table. The ``heart`` most frequent pairs go to the tasks, the rest are joined by pair.
The baseline's counts stay in a table: words of at least ``word_share`` of all tokens
(at most ``1 / word_share`` of them) go to the tasks, the rest are joined by word.
Sums of logarithms are taken as whole numbers, so no score depends on the order of rows or on ``heart``.

Defined results: a null or wordless text holds the end alone; repeated and null
ids are rows of their own (a null id neither trains nor is held out); an empty
table gives an empty result; with nothing to learn from every byte has probability 1/256; columns
other than id and text are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import lean, lowered, stored, text_slices, word_hashes, word_spans

CLOSE = 0x0A      # closes a text, and stands before its first byte
END_WORD = 0x5EED  # the end token's key among the word hashes
UNIT = 1 << 30     # log10 probabilities of pairs are whole numbers of 1 / UNIT
FINE = 1 << 40     # parts of a logarithm's fraction while children are summed
HELD_KEYS = 1_500_000  # distinct keys a counting task holds before it hands over partial sums


@dataclass(frozen=True)
class Shape:
    """Depth of the tree (at most 6), and how many pairs and which share of words tasks know by heart."""

    depth: int = 5
    heart: int = 500_000
    word_share: float = 1e-6


def streams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The byte streams of consecutive texts, each led by ``depth`` closing bytes: bytes, and where each text begins (n + 1 long)."""
    words = np.diff(first)
    last = np.zeros(len(starts), dtype=bool)
    last[first[1:][words > 0] - 1] = True
    gaps = ends[~last]  # the byte after a word that another one of its text follows becomes a space
    low = lowered(data)
    low[gaps] = 0x20
    kept = _covered(starts, ends, len(data))
    kept[gaps] = True
    size = np.append(0, np.cumsum(ends - starts + 1))[first]  # a text's words, each with the byte after it
    bounds = size + np.append(0, np.cumsum(depth + (words == 0)))  # an empty text's lead holds its close
    out = np.full(bounds[-1], CLOSE, dtype=np.uint8)
    some = words > 0
    out[_covered(bounds[:-1][some] + depth, bounds[1:][some] - 1, len(out))] = low[kept]
    return out, bounds


def _covered(starts: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """Which of ``length`` places lie in the given ranges, which do not overlap."""
    steps = np.zeros(length + 1, dtype=np.int8)
    steps[starts] = 1
    steps[ends] -= 1
    return np.cumsum(steps[:-1], dtype=np.int8).view(bool)


def gram_codes(stream: np.ndarray, bounds: np.ndarray, depth: int) -> np.ndarray:
    """Per coded byte: the preceding bytes, latest highest, then the byte itself."""
    at = np.ones(len(stream), dtype=bool)
    for k in range(depth):
        at[bounds[:-1] + k] = False
    # eight bytes from every place on, the first lowest: the context of the byte ``depth`` places on, then that byte
    padded = np.append(stream, np.zeros(8, np.uint8))
    code = np.ndarray(max(len(stream) - depth, 0), "<u8", padded, strides=(1,))[at[depth:]]
    byte = (code >> np.uint64(8 * depth)) & np.uint64(255)
    code &= np.uint64((1 << 8 * depth) - 1)
    code <<= np.uint64(8)
    code |= byte
    return code


class Tally:
    """Counts per 64-bit key within a task, handed over when there are many keys."""

    def __init__(self) -> None:
        self.keys, self.counts, self.new, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

    def add(self, keys: np.ndarray) -> bool:
        """Count the keys; whether it is time to hand over."""
        some = np.unique(keys, return_counts=True)
        self.new.append(some)
        self.size += len(some[0])
        if self.size > HELD_KEYS:
            self._merge()
        return len(self.keys) > HELD_KEYS

    def _merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.new)])
        counts = np.concatenate([self.counts, *(c for _, c in self.new)])
        self.__init__()  # the parts go before the sort takes memory
        order = np.argsort(keys, kind="stable")  # the parts are sorted runs, which a stable sort merges
        keys = keys[order]
        kinds = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        self.keys, self.counts = keys[kinds], np.add.reduceat(counts[order], kinds) if len(keys) else counts

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        self._merge()
        out = self.keys, self.counts
        self.__init__()
        return out


class Places:
    """Where 64-bit keys stand among distinct known ones: a table of slots, a key in the first free one from its own on.

    Keys named first are met first, so the most frequent ones should lead.
    """

    def __init__(self, known: np.ndarray) -> None:
        self.bits = max(1, (2 * len(known)).bit_length())
        self.keys, self.place = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, -1, np.int32)
        left, at = np.arange(len(known)), self._own(known)
        while len(left):
            free = np.flatnonzero(self.place[at] < 0)
            slots, won = np.unique(at[free], return_index=True)
            won = free[won]
            self.place[slots], self.keys[slots] = left[won], known[left[won]]
            lost = np.ones(len(left), dtype=bool)
            lost[won] = False
            left, at = left[lost], self._next(at[lost])

    def _own(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def _next(self, at: np.ndarray) -> np.ndarray:
        return (at + 1) & ((1 << self.bits) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Each key's place among the known ones, or -1."""
        at = self._own(keys)
        out = self.place[at]
        other = self.keys[at] != keys  # a free slot ends the search, whatever key it is compared with
        more = np.flatnonzero(other & (out >= 0))
        out[other] = -1
        at = at[more]
        while len(more):
            at = self._next(at)
            place, same = self.place[at], self.keys[at] == keys[more]
            out[more[same]] = place[same]
            go = ~same & (place >= 0)
            more, at = more[go], at[go]
        return out


def counts(texts: DataFrame, depth: int) -> DataFrame:
    """(word, key, n): the counts of all (context, byte) grams and, where ``word``, of all tokens of ``texts`` (text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, words = Tally(), Tally()

        def rows(tally: Tally, word: bool) -> Iterator[pa.RecordBatch]:
            keys, n = tally.take()
            for a in range(0, len(keys), 100_000):
                k = keys[a : a + 100_000].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), word)), pa.array(k), pa.array(n[a : a + 100_000])], ["word", "key", "n"])

        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                starts, ends, first = word_spans(data, offsets)
                stream, bounds = streams(data, starts, ends, first, depth)
                if grams.add(gram_codes(stream, bounds, depth)):
                    yield from rows(grams, False)
                if words.add(np.append(word_hashes(data, starts, ends), np.full(len(offsets) - 1, END_WORD, dtype=np.uint64))):
                    yield from rows(words, True)
        yield from rows(grams, False)
        yield from rows(words, True)

    parts = texts.select("text").mapInArrow(lean(count), "word boolean, key long, n long")
    return parts.groupBy("word", "key").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Tree:
    """``child[node, byte]``: the node of the context one byte longer, or -1; its last row, that of -1, is all -1.

    Nodes are ordered by depth, and those of full depth have no row. ``log10[node, byte]``: the byte's log-probability
    where the node is the deepest on its path.
    """

    depth: int
    child: np.ndarray
    log10: np.ndarray


def _log_kt(ones: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov estimate of ``zeros`` zeros and ``ones`` ones."""
    out, at = np.zeros(ones.shape), np.nonzero(ones + zeros)
    a, b = ones[at], zeros[at]
    for values, shift, sign in ((a, 0.5, 1), (b, 0.5, 1), (a + b, 1.0, -1)):
        kinds, back = np.unique(values, return_inverse=True)
        out[at] += sign * np.array([math.lgamma(x + shift) for x in kinds])[back]
    out[at] -= 2 * math.lgamma(0.5)
    return out


def _mixture(pair: np.ndarray, rest: np.ndarray, level: np.ndarray, up: np.ndarray, depth: int) -> np.ndarray:
    """Probability of a one, per node and decision, where the node is the deepest on the path.

    ``pair`` (nodes x decisions x 2) counts zeros and ones; ``rest`` those that no child of the node holds.
    """
    own, split = _log_kt(pair[:, :, 1], pair[:, :, 0]), _log_kt(rest[:, :, 1], rest[:, :, 0])
    weighted, half = own.copy(), math.log(0.5)
    for d in range(depth, -1, -1):  # from the deepest nodes to the root
        at = np.flatnonzero(level == d)
        if d < depth:
            weighted[at] = np.logaddexp(half + own[at], half + split[at])
        if d:
            np.add.at(split, up[at], weighted[at])
    stop = np.exp(half + own - weighted)  # the share of the node's own estimate in its mixture
    stop[level == depth] = 1.0
    estimate = (pair[:, :, 1] + 0.5) / (pair.sum(axis=2) + 1.0)
    fixed, share = np.zeros_like(own), np.ones_like(own)
    for d in range(depth + 1):  # what the mixtures above a node leave to the estimate below it
        at = np.flatnonzero(level == d)
        if d:
            fixed[at], share[at] = fixed[up[at]], share[up[at]]
        fixed[at] += share[at] * stop[at] * estimate[at]
        share[at] *= 1.0 - stop[at]
    return np.clip(fixed + share * (rest[:, :, 1] + 0.5) / (rest.sum(axis=2) + 1.0), 1e-12, 1 - 1e-12)


def weigh(depths: np.ndarray, contexts: np.ndarray, bytes_: np.ndarray, n: np.ndarray, depth: int) -> Tree:
    """Context-tree weighting in one process, which tests hold ``pair_logs`` to; ``contexts`` hold a node's bytes, latest highest."""
    named = (depths.astype(np.uint64) << np.uint64(56)) | contexts.astype(np.uint64)
    keys = np.union1d(named, np.zeros(1, np.uint64))  # the root is always there
    size, level = len(keys), (keys >> np.uint64(56)).astype(np.int64)
    context = keys & np.uint64((1 << 56) - 1)
    table = np.zeros((size, 256))
    table[np.searchsorted(keys, named), bytes_] = n
    up = np.searchsorted(keys, ((np.maximum(level, 1) - 1).astype(np.uint64) << np.uint64(56)) | (context >> np.uint64(8)))
    kids = np.flatnonzero(level)
    rest = table.copy()
    for a in range(0, len(kids), 2048):
        np.subtract.at(rest, up[kids[a : a + 2048]], table[kids[a : a + 2048]])

    log10 = np.zeros((size, 1), dtype=np.float32)
    for bit in range(8):  # a decision for every prefix of ``bit`` bits; decisions are independent, so taken in groups
        finer = np.empty((size, 1 << bit, 2), dtype=np.float32)
        for a in range(0, 1 << bit, 16):
            group = slice(a, a + 16)
            pair, left = (t.reshape(size, 1 << bit, 2, -1)[:, group].sum(axis=3) for t in (table, rest))
            one = _mixture(pair, left, level, up, depth)
            finer[:, group, 0], finer[:, group, 1] = np.log10(1 - one), np.log10(one)
        finer += log10[:, :, None]
        log10 = finer.reshape(size, -1)
    del table, rest
    child = np.full((int((level < depth).sum()) + 1, 256), -1, dtype=np.int32)
    child[up[kids], (context[kids] & np.uint64(255)).astype(np.int64)] = kids
    return Tree(depth, child, log10)


def _log_gamma(x: Column) -> Column:
    """Natural logarithm of the gamma function, by Stirling's series from ``x + 8`` on."""
    y, product = x + 8, x
    for k in range(1, 8):
        product = product * (x + k)
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def _kt(zeros: Column, ones: Column) -> Column:
    """As ``_log_kt``, of columns."""
    a, b = zeros.cast("double"), ones.cast("double")
    kt = _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1) - math.log(math.pi)
    return F.when(zeros + ones == 0, 0.0).otherwise(kt)


def _decisions(pairs: DataFrame) -> DataFrame:
    """The eight decisions of every pair: ``node``, the context followed by a one and the bits so far, and the next ``bit``."""
    return pairs.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(7)))).select(
        *pairs.columns,
        F.expr("shiftleft(shiftrightunsigned(key, 8), 8) | shiftleft(1L, i) | shiftright(key & 255, 8 - i)").alias("node"),
        F.expr("shiftright(key & 255, 7 - i) & 1").alias("bit"),
    )


def pair_logs(pairs: DataFrame, depth: int) -> DataFrame:
    """(key, seen, units): log10 of the weighted probability of each pair's byte after its context, in 1 / ``UNIT``.

    ``pairs`` (key, n, seen) are stored and hold ``n``, the count in training, or 0.
    """
    up, half = F.expr("shiftleft(shiftrightunsigned(node, 16), 8) | (node & 255)"), math.log(0.5)
    sums = [F.sum(c).alias(c) for c in ("zeros", "ones")]
    counted = _decisions(pairs).select("node", (F.col("n") * (1 - F.col("bit"))).alias("zeros"), (F.col("n") * F.col("bit")).alias("ones"))
    level = counted.groupBy("node").agg(*sums).withColumn("weighted", _kt(F.col("zeros"), F.col("ones"))).withColumn("stop", F.lit(1.0))
    levels = [stored(level, "tree-level")]
    for _ in range(depth):  # from the deepest nodes to the root
        whole = F.floor("weighted")
        above = (
            levels[-1].select(up.alias("node"), "zeros", "ones", whole.alias("whole"), F.round((F.col("weighted") - whole) * FINE).cast("long").alias("part"))
            .groupBy("node").agg(*sums, (F.sum("whole") + F.sum("part") / F.lit(float(FINE))).alias("split"))
            .withColumn("own", _kt(F.col("zeros"), F.col("ones")))
        )
        weighted = half + F.greatest("own", "split") + F.log1p(F.exp(-F.abs(F.col("own") - F.col("split"))))
        stop = 1 / (1 + F.exp(F.col("split") - F.col("own")))  # the share of the node's own estimate in its mixture
        levels.append(stored(above.select("node", "zeros", "ones", weighted.alias("weighted"), stop.alias("stop")), "tree-level"))
    estimate = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)
    own = [(F.col("stop") * estimate).alias("mine"), (1 - F.col("stop")).alias("go")]
    mixed = levels[-1].select("node", *own).withColumnsRenamed({"mine": "fixed", "go": "share"})
    # the joins grow with the corpus: both sides are shuffled and sorted, whatever size the files of one seem to have
    for level in levels[-2::-1]:  # what the mixtures above a node leave to the estimate below it
        below = level.select("node", up.alias("up"), *own).join(mixed.withColumnRenamed("node", "up").hint("merge"), "up")
        mixed = stored(below.select("node", (F.col("fixed") + F.col("share") * F.col("mine")).alias("fixed"), (F.col("share") * F.col("go")).alias("share")), "tree-mixture")
    one = F.least(F.greatest(F.col("fixed"), F.lit(1e-12)), F.lit(1 - 1e-12))
    log = F.log10(F.when(F.col("bit") == 1, one).otherwise(1 - one))
    bits = _decisions(pairs.select("key", "seen")).hint("merge").join(mixed.select("node", "fixed"), "node")
    return bits.groupBy("key").agg(F.first("seen").alias("seen"), F.sum(F.round(log * UNIT).cast("long")).alias("units"))


def by_heart(logs: DataFrame, most: int) -> int:
    """The least ``seen`` of which at most ``most`` pairs have as much or more."""
    sizes = logs.groupBy(F.floor(F.log2("seen") * 8).alias("size")).agg(F.count("*").alias("pairs"), F.min("seen").alias("least"), F.max("seen").alias("top")).collect()
    least = max((r["top"] for r in sizes), default=0) + 1
    for r in sorted(sizes, key=lambda r: -r["size"]):
        most -= r["pairs"]
        if most < 0:
            break
        least = r["least"]
    return least


def code_lengths(tree: Tree, stream: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """log10 probability of each text of a stream."""
    flat, node = tree.child.ravel(), np.zeros(len(stream), dtype=np.int64)
    deepest = node
    for k in range(1, tree.depth + 1):  # leading bytes are not coded, so what they look back on does not matter
        back = np.empty_like(stream)
        back[k:], back[:k] = stream[:-k], CLOSE
        node = flat[node * 256 + back].astype(np.int64)
        deepest = np.where(node < 0, deepest, node)
    logs = tree.log10.ravel()[deepest * 256 + stream].astype(np.float64)
    for k in range(tree.depth):
        logs[bounds[:-1] + k] = 0.0
    return np.add.reduceat(logs, bounds[:-1]) if len(bounds) > 1 else np.zeros(0)


def score(docs: DataFrame, held_out: Column, shape: Shape = Shape(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every text, learning from those not held out.

    doc_id, held_out; n_tokens: words and the end; n_known: tokens met in training; train_tokens; base_score: log10
    of the smoothed unigram probability; score: log10 of the context-tree probability; bits_per_byte: its code length per byte.
    """
    id_type, depth = dict(docs.dtypes)[id_col], shape.depth
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held_out.alias("held_out"))
    learns = F.coalesce(~F.col("held_out"), F.lit(False))
    counted = stored(counts(rows.where(learns), depth), "text-counts")
    others = counts(rows.where(~learns), depth).where(~F.col("word"))
    pairs = counted.where(~F.col("word")).select("key", "n", F.col("n").alias("seen")).unionAll(others.select("key", F.lit(0).cast("long"), "n"))
    pairs = stored(pairs.groupBy("key").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen")), "text-pairs")
    logs = stored(pair_logs(pairs, depth), "pair-logs")
    least_seen = by_heart(logs, shape.heart)
    often_pairs = logs.where(F.col("seen") >= least_seen).select("key", "units", "seen").toArrow()  # at most ``heart``
    order = np.argsort(-often_pairs["seen"].to_numpy())
    pair_places = Places(often_pairs["key"].to_numpy()[order].astype(np.int64).view(np.uint64))
    pair_units = np.append(often_pairs["units"].to_numpy()[order].astype(np.int64), 0)  # the last for pairs not among them
    vocabulary = counted.where("word").select("key", "n")
    train = vocabulary.agg(F.sum("n").alias("tokens"), F.count("*").alias("kinds")).first()
    tokens, kinds = train["tokens"] or 0, train["kinds"]
    least = max(1.0, shape.word_share * tokens)
    often = vocabulary.where(F.col("n") >= least).toPandas()  # at most 1 / word_share words
    order = np.argsort(-often["n"].to_numpy(dtype=np.int64))
    known = Places(often["key"].to_numpy(dtype=np.int64)[order].view(np.uint64))
    known_log = np.log10(often["n"].to_numpy(dtype=float)[order] + 0.1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << 33
        fields = ["row", "doc_id", "held_out", "n_tokens", "n_often", "log_often", "units", "n_bytes", "word", "pair", "times"]
        for batch in batches:
            for a, b, data, offsets in text_slices(batch.column(1)):
                part, n = batch.slice(a, b - a), b - a
                starts, ends, first = word_spans(data, offsets)
                stream, bounds = streams(data, starts, ends, first, depth)
                size = np.diff(bounds) - depth
                codes = gram_codes(stream, bounds, depth)
                place = pair_places.find(codes)
                strange = np.flatnonzero(place < 0)
                begin = np.cumsum(size) - size
                units = np.add.reduceat(pair_units[place], begin)  # every text codes one byte at least
                words = np.append(word_hashes(data, starts, ends), np.full(n, END_WORD, dtype=np.uint64))
                text = np.append(np.repeat(np.arange(n), np.diff(first)), np.arange(n))
                place = known.find(words)
                hit = place >= 0
                log_often = np.bincount(text[hit], weights=known_log[place[hit]], minlength=n).astype(float)  # whole numbers without a hit
                numbers = row + np.arange(n)
                row += n
                none = pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(numbers), part.column(0), part.column(2), pa.array(np.diff(first) + 1, pa.int64()),
                        pa.array(np.bincount(text[hit], minlength=n), pa.int64()), pa.array(log_often),
                        pa.array(units, pa.int64()), pa.array(size, pa.int64()), none, none, none,
                    ], fields,
                )
                # the other words and pairs, once per text with their number
                for k, t, is_pair in ((words[~hit], text[~hit], False), (codes[strange], np.searchsorted(begin, strange, side="right") - 1, True)):
                    by = np.lexsort((k, t))
                    k, t = k[by], t[by]
                    new = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (t[1:] != t[:-1]))) if len(k) else np.zeros(0, np.int64)
                    times = np.diff(np.append(new, len(k)))
                    for x in range(0, len(new), 100_000):
                        y = new[x : x + 100_000]
                        m = len(y)
                        longs, keys = pa.nulls(m, pa.int64()), pa.array(k[y].view(np.int64))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(numbers[t[y]]), pa.nulls(m, part.column(0).type), pa.nulls(m, pa.bool_()), longs, longs,
                                pa.nulls(m, pa.float64()), longs, longs, longs if is_pair else keys, keys if is_pair else longs,
                                pa.array(times[x : x + 100_000], pa.int64()),
                            ], fields,
                        )

    schema = (
        f"row long, doc_id {id_type}, held_out boolean, n_tokens long, n_often long, log_often double, units long, "
        "n_bytes long, word long, pair long, times long"
    )
    scored = stored(rows.mapInArrow(lean(run), schema), "text-scores")
    rare = scored.where("word IS NOT NULL").select("row", "word", "times").join(
        vocabulary.where(F.col("n") < least).withColumnRenamed("key", "word").hint("merge"), "word", "left"
    ).groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("n_rare"),
        F.sum(F.col("times") * F.log10(F.coalesce(F.col("n"), F.lit(0)) + F.lit(0.1))).alias("log_rare"),
    )
    rare_pairs = scored.where("pair IS NOT NULL").select("row", "pair", "times").join(
        logs.where(F.col("seen") < least_seen).select(F.col("key").alias("pair"), F.col("units").alias("each")).hint("merge"), "pair"
    ).groupBy("row").agg(F.sum(F.col("times") * F.col("each")).alias("more_units"))
    whole = math.log10(tokens + 0.1 * (kinds + 1))
    base = F.col("log_often") + F.coalesce(F.col("log_rare"), F.lit(0.0)) - F.col("n_tokens") * F.lit(whole)
    score = (F.col("units") + F.coalesce("more_units", F.lit(0))) / F.lit(float(UNIT))
    whole_texts = scored.where("word IS NULL AND pair IS NULL").join(rare, "row", "left").join(rare_pairs, "row", "left")
    return whole_texts.select(
        "doc_id", F.coalesce("held_out", F.lit(False)).alias("held_out"), "n_tokens",
        (F.col("n_often") + F.coalesce("n_rare", F.lit(0))).cast("long").alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"),
        (-score * F.lit(math.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
