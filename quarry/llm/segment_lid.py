"""Language identification by unigram models whose segmentations are summed out.

The pieces are those of a fixed public vocabulary (its path is a parameter) that
lower-cased text can hold, and the 256 single bytes. A language has a probability
per piece. The probability of a word is the sum over all ways of writing it,
led by the word mark, as a sequence of pieces: a forward pass over its lattice. No piece
crosses a word boundary, so a text's log-probability is the sum over its words.
The languages' posterior, all equal beforehand, gives prediction and score.

The piece probabilities are fitted by expectation maximisation on a bounded
sample of labelled texts, about ``Fit.docs`` per language, taken by a hash of the row;
every word of theirs trains, long ones (as in scripts without spaces) cut between characters; words are counted by Spark, and what reaches the driver is bounded by the sample.
Scoring reads every text whole, shuffles nothing, and keeps word scores of up to
``KNOWN_WORDS`` words per Python worker.

Defined results: ``und`` with score 0 for a null text, a text without a letter,
or when there are no labelled texts to learn from; ties go to the first language in
alphabetical order; repeated rows give equal rows; columns other than those asked for are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import _powers, give_back, lean, mix, text_slices, word_hashes, word_spans

MARK = "▁"
SHORT = 48            # bytes; longer words are scored one by one in logarithms, and train in cuts of so many
BYTE_SCALE = 16.0     # keeps the forward values of short words within floating range
KNOWN_WORDS = 400_000
LATTICE_WORDS = 4_000  # words of one forward pass when texts are scored; a pass takes some 3 kB a word at four languages


@dataclass(frozen=True)
class Fit:
    """How the piece probabilities are fitted; ``docs`` bounds the labelled sample, per language, in expectation."""

    docs: int = 200
    rounds: int = 4
    prior: float = 0.02


class Vocabulary:
    """Pieces by number, found in a byte buffer through hashes of its substrings."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        texts = [n.encode() for n in names if n == n.lower() and MARK not in n[1:] and not any(c.isspace() for c in n)]
        self.size = len(texts) + 256  # the last 256 are the single bytes
        self.first_byte = len(texts)
        self.lengths = sorted({len(t) for t in texts})
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        h = self._hashes(data, ends - [len(t) for t in texts], ends)
        order = np.argsort(h)
        self.sorted, self.number = h[order], order
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(h >> np.uint64(44)).astype(np.int64)] = True

    @staticmethod
    def _sums(data: np.ndarray) -> np.ndarray:
        up, _ = _powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
        return sums

    @classmethod
    def _hashes(cls, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
        sums = cls._sums(data) if sums is None else sums
        _, down = _powers(len(data) + 1)
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))

    def arcs(self, data: np.ndarray, word_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, piece) of every occurrence of a piece in ``data``, none beyond the end of its word."""
        room, sums = word_end - np.arange(len(data)), self._sums(data)
        found = [(np.arange(len(data)), np.ones(len(data), dtype=np.int64), self.first_byte + data.astype(np.int64))]
        for n in self.lengths:
            at = np.flatnonzero(room >= n)
            if not len(at):
                break
            h = self._hashes(data, at, at + n, sums)
            likely = self.maybe[(h >> np.uint64(44)).astype(np.int64)]
            at, h = at[likely], h[likely]
            i = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
            hit = self.sorted[i] == h
            found.append((at[hit], np.full(int(hit.sum()), n), self.number[i[hit]]))
        return tuple(np.concatenate(x) for x in zip(*found))


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Lattice:
    """All segmentations of a list of words; nodes are byte positions, word after word."""

    def __init__(self, vocab: Vocabulary, words: list[bytes]) -> None:
        marked = [MARK.encode() + w for w in words]
        lengths = np.array([len(w) for w in marked], dtype=np.int64)
        data = np.frombuffer(b"".join(marked), dtype=np.uint8)
        ends = np.cumsum(lengths)
        start, n, self.piece = vocab.arcs(data, np.repeat(ends, lengths))
        word = np.repeat(np.arange(len(words)), lengths)[start]
        self.first = ends - lengths + np.arange(len(words))  # every word has one node more than bytes
        self.last = self.first + lengths
        self.source, self.target = (start + word).astype(np.int32), (start + word + n).astype(np.int32)
        self.word, self.length, self.piece = word.astype(np.int32), n.astype(np.int32), self.piece.astype(np.int32)
        self.lengths, self.nodes = lengths, int(lengths.sum()) + len(words)

    def _by_depth(self, node: np.ndarray) -> list[np.ndarray]:
        """Arcs grouped by their node's place in its word, and within that by node."""
        depth = node - self.first[self.word]
        order = np.lexsort((node, depth))
        return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)

    def _pass(self, weight: np.ndarray, origin: np.ndarray, into: np.ndarray, out_of: np.ndarray, backwards: bool) -> np.ndarray:
        value = np.zeros((self.nodes, weight.shape[1]))
        value[origin] = 1.0
        for arcs in self._by_depth(into)[:: -1 if backwards else 1]:
            node = into[arcs]
            firsts = np.concatenate([[0], np.flatnonzero(np.diff(node)) + 1])
            value[node[firsts]] = np.add.reduceat(value[out_of[arcs]] * weight[arcs], firsts, axis=0)
        return value

    def weights(self, theta: np.ndarray) -> np.ndarray:
        return theta[self.piece] * (BYTE_SCALE ** self.length.astype(float))[:, None]

    def forward(self, weight: np.ndarray) -> np.ndarray:
        return self._pass(weight, self.first, self.target, self.source, False)

    def backward(self, weight: np.ndarray) -> np.ndarray:
        return self._pass(weight, self.last, self.source, self.target, True)

    def log_probability(self, theta: np.ndarray) -> np.ndarray:
        """Natural logarithm per word and language."""
        total = self.forward(self.weights(theta))[self.last]
        return np.log(np.maximum(total, 1e-300)) - (self.lengths * math.log(BYTE_SCALE))[:, None]


def long_word(vocab: Vocabulary, word: bytes, theta: np.ndarray) -> np.ndarray:
    """The forward pass of one word of any length, in logarithms."""
    lattice, log_theta = Lattice(vocab, [word]), np.log(theta)
    order = np.argsort(lattice.target, kind="stable")
    source, target, step = lattice.source[order], lattice.target[order], log_theta[lattice.piece[order]]
    value = np.full((lattice.nodes, theta.shape[1]), -np.inf)
    value[0] = 0.0
    cuts = np.searchsorted(target, np.arange(1, lattice.nodes + 1))
    for node in range(1, lattice.nodes):
        a, b = cuts[node - 1], cuts[node]
        value[node] = np.logaddexp.reduce(value[source[a:b]] + step[a:b], axis=0)
    return value[-1]


def cut_words(words: list[bytes], counts: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The words in cuts of at most ``SHORT`` bytes, between characters, each with the counts of its word."""
    cuts, owner = [], []
    for i, w in enumerate(words):
        at = 0
        while at < len(w):
            end = min(at + SHORT, len(w))
            while end < len(w) and end > at + 1 and w[end] & 0xC0 == 0x80:
                end -= 1
            cuts.append(w[at:end])
            owner.append(i)
            at = end
    return cuts, counts[owner]


def fit(vocab: Vocabulary, words: list[bytes], counts: np.ndarray, how: Fit) -> np.ndarray:
    """Piece probabilities per language (pieces x languages) from word counts (words x languages)."""
    words, counts = cut_words(words, counts)
    theta = np.full((vocab.size, counts.shape[1]), 1.0 / vocab.size)
    parts = [(Lattice(vocab, words[a : a + 5_000]), counts[a : a + 5_000]) for a in range(0, len(words), 5_000)]
    for _ in range(how.rounds):
        expected = np.full_like(theta, how.prior)
        for lattice, c in parts:
            w = lattice.weights(theta)
            ahead, behind = lattice.forward(w), lattice.backward(w)
            share = c / np.maximum(ahead[lattice.last], 1e-300)
            used = ahead[lattice.source] * w * behind[lattice.target] * share[lattice.word]
            for k in range(theta.shape[1]):
                expected[:, k] += np.bincount(lattice.piece, weights=used[:, k], minlength=vocab.size)
        theta = expected / expected.sum(axis=0)
    return theta


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    theta: np.ndarray
    vocabulary_path: str


def learn(labelled: DataFrame, vocabulary_path: str, how: Fit = Fit()) -> Model:
    """Fit on ``labelled`` (text, lang, and what else tells rows apart): a sample of about ``how.docs`` texts per language, by a hash of the row.

    Rows with a null text or language are left out.
    """
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    chance = F.least(F.lit(1.0), F.lit(float(how.docs)) / F.col("n"))
    draw = F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.join(F.broadcast(sizes), "lang").where(draw < chance)  # one row per language
    counted = (
        sample.select("lang", F.explode(F.split(F.lower("text"), r"[\x20\x09-\x0D]+")).alias("word"))
        .where("word <> ''").groupBy("lang", "word").agg(F.count("*").alias("n")).toPandas()
    )
    languages = tuple(sorted(r["lang"] for r in sizes.select("lang").collect()))
    words = sorted(set(counted["word"]))
    place, column = {w: i for i, w in enumerate(words)}, {k: i for i, k in enumerate(languages)}
    counts = np.zeros((len(words), len(languages)))
    np.add.at(counts, ([place[w] for w in counted["word"]], [column[k] for k in counted["lang"]]), counted["n"].to_numpy(dtype=float))
    return Model(languages, fit(vocabulary(vocabulary_path), [w.encode() for w in words], counts, how), vocabulary_path)


class WordScores:
    """Log-probabilities of words already met, by word hash."""

    def __init__(self, model: Model) -> None:
        self.model, self.vocab = model, vocabulary(model.vocabulary_path)
        self.hashes, self.scores = np.zeros(0, np.uint64), np.zeros((0, len(model.languages)))

    def _new(self, words: list[bytes]) -> np.ndarray:
        out = np.zeros((len(words), len(self.model.languages)))
        short = [i for i, w in enumerate(words) if len(w) <= SHORT]
        for a in range(0, len(short), LATTICE_WORDS):
            some = short[a : a + LATTICE_WORDS]
            out[some] = Lattice(self.vocab, [words[i] for i in some]).log_probability(self.model.theta)
        for i, w in enumerate(words):
            if len(w) > SHORT:
                out[i] = long_word(self.vocab, w, self.model.theta)
        return out

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Per word, the log-probability per language."""
        distinct, sample, back = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.hashes, distinct), max(len(self.hashes) - 1, 0))
        known = self.hashes[place] == distinct if len(self.hashes) else np.zeros(len(distinct), dtype=bool)
        scores = np.zeros((len(distinct), len(self.model.languages)))
        scores[known] = self.scores[place[known]]
        if not known.all():
            raw, new = data.tobytes(), np.flatnonzero(~known)
            scores[new] = self._new([raw[starts[i] : ends[i]] for i in sample[new]])
            keep = len(self.hashes) + len(new) <= KNOWN_WORDS
            hashes = np.concatenate([self.hashes, distinct[new]]) if keep else distinct
            values = np.concatenate([self.scores, scores[new]]) if keep else scores
            order = np.argsort(hashes)
            self.hashes, self.scores = hashes[order], values[order]
        return scores[back]


def identify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", more: list[Column] | None = None
) -> DataFrame:
    """(doc_id, lang_pred, score) of every text; ``more`` columns are carried along."""
    inputs = docs.select(
        F.lower(F.col(text_col)).alias("_text"), F.coalesce(F.rlike(F.col(text_col), F.lit(r"\p{L}")), F.lit(False)).alias("_letters"),
        F.col(id_col).alias("doc_id"), *(more or []),
    )
    carried = inputs.columns[2:]
    languages = model.languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = WordScores(model)
        for batch in batches:
            give_back()  # what the vocabulary or the batch before took beside what is kept
            for a, b, data, offsets in text_slices(batch.column(0)):
                part = batch.slice(a, b - a)
                starts, ends, first = word_spans(data, offsets)
                sums = np.zeros((len(starts) + 1, len(languages)))
                if languages and len(starts):
                    np.cumsum(scores(data, starts, ends), axis=0, out=sums[1:])
                total = sums[first[1:]] - sums[first[:-1]]
                found, chance = ["und"] * len(total), np.zeros(len(total))
                letters = np.array(part.column(1).to_pylist(), dtype=bool)
                if languages:
                    odds = np.exp(total - total.max(axis=1, keepdims=True))
                    best = total.argmax(axis=1)
                    found = [languages[k] if ok else "und" for k, ok in zip(best, letters)]
                    chance = np.where(letters, 1.0 / odds.sum(axis=1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[2:], pa.array(found, pa.string()), pa.array(chance, pa.float64())], [*carried, "lang_pred", "score"]
                )

    kinds = dict(inputs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in carried), "lang_pred string", "score double"])
    return inputs.mapInArrow(lean(run), schema)


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether the row's id falls into the fold that is kept from learning; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds)) == fold


def default_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def identify_documents(docs: DataFrame, vocabulary_path: str | None = None, how: Fit = Fit()) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learnt from the labelled documents outside the held-out fold."""
    path = vocabulary_path or default_path()
    model = learn(docs.where(~held_out()).select("doc_id", "text", "lang"), path, how)
    found = identify(docs, model, more=[F.coalesce(held_out(), F.lit(False)).alias("held_out")])
    return found.select("doc_id", "held_out", "lang_pred", "score")


def known_language(docs: DataFrame, least: float = 0.5, vocabulary_path: str | None = None, how: Fit = Fit()) -> DataFrame:
    """``docs`` without texts of no language (``und``) or whose best language has under ``least`` of the posterior."""
    path = vocabulary_path or default_path()
    model = learn(docs.where(~held_out()).select("doc_id", "text", "lang"), path, how)
    found = identify(docs, model, more=[F.struct("*").alias("_row")])
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= least)).select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
