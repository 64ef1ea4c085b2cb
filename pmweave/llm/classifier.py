"""Quality classifier: random-indexing word vectors, pooled per document, under a two-layer network.

A word has a sparse random index vector, drawn from its own hash, and a context vector, the sum of the
index vectors of the words around it over the whole corpus: tasks sum integers over their rows, one
grouped sum per word adds the tasks up. Words that make up at least a given share of all words, counted before, have
context vectors, so their table is bounded by that share whatever the corpus; a rarer word has its index vector alone. A document is the
mean and the spread of its words' vectors. The network is trained in numpy on a bounded sample of labelled
documents and its logits are divided by a temperature fitted on the part of them that was not trained on.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pmweave.llm.workers import importable
from pmweave.session import stage

DIMS = 64
NONZERO = 8
REACH = 2
LEAST_SHARE = 1 / (1 << 16)  # of all words; at most 65,536 words can have it
MAX_LABELLED = 20_000
WORDS_AT_ONCE = 1 << 16
WORDS_KEPT = 1 << 17  # distinct words a task holds before it hands on what it has of them
FRESH_AT_ONCE, TEXTS_AT_ONCE = 1 << 12, 256
TOKEN = re.compile(r"\w+|[^\w\s]+")
INPUTS = 4 * DIMS


def index_vectors(words: np.ndarray) -> np.ndarray:
    """Ternary vectors of word hashes: ``NONZERO`` times seven bits of the hash name a place and a sign; draws of one place add up."""
    vectors, rows = np.zeros((len(words), DIMS), np.int8), np.arange(len(words))
    for draw in range(NONZERO):
        bits = (words >> np.uint64(7 * draw)).astype(np.int64)
        vectors[rows, bits & 63] += (1 - 2 * (bits >> 6 & 1)).astype(np.int8)
    return vectors


class Words(dict):
    """Words to numbers from 1 on in the order they came, with hashes, index vectors and places by number; 0 is no word. Case is part of a word.

    The place of a word is its number, or if ``only`` some hashes (in order) matter, from 1 on among those and 0 for the rest.
    """

    def __init__(self, only: np.ndarray | None = None):
        self.only, self.fresh = only, []
        self.hashes, self.places, self.index = np.zeros(1024, np.uint64), np.zeros(1024, np.int32), np.zeros((1024, DIMS), np.int8)

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self) + 1
        self.fresh.append(word)
        return n

    def numbers(self, text: str | None) -> np.ndarray:
        """Of the words of a text; ``settle`` enters those that are new into the tables."""
        return np.fromiter(map(self.__getitem__, TOKEN.findall(text or "")), np.int32)

    def settle(self) -> None:
        if not self.fresh:
            return
        first, end = len(self) + 1 - len(self.fresh), len(self) + 1
        if end > len(self.hashes):
            more = max(end, 2 * len(self.hashes)) - len(self.hashes)
            self.hashes = np.concatenate((self.hashes, np.zeros(more, np.uint64)))
            self.places = np.concatenate((self.places, np.zeros(more, np.int32)))
            self.index = np.concatenate((self.index, np.zeros((more, DIMS), np.int8)))
        self.hashes[first:end] = found = word_hashes(self.fresh)
        self.places[first:end] = np.arange(first, end) if self.only is None else 1 + positions(self.only, found)
        self.index[first:end] = index_vectors(found)
        self.fresh.clear()


def word_hashes(words: Iterable[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) for word in words], np.uint64)


def positions(hashes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Of ``wanted`` hashes among ``hashes``, which are in order; -1 for those that are not there."""
    if not len(hashes):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
    return np.where(hashes[at] == wanted, at, -1)


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(word, n)``: how often each word (a hash) occurs in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for value in batch.column(0):
                seen.update(TOKEN.findall(value.as_py() or ""))
                if len(seen) >= WORDS_KEPT:
                    yield counted(seen)
                    seen.clear()
        yield counted(seen)

    def counted(seen: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(word_hashes(seen).view(np.int64)), pa.array(seen.values(), pa.int64())], names=["word", "n"])

    parts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word long, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def context_sums(docs: DataFrame, text_col: str = "text", only: np.ndarray | None = None) -> DataFrame:
    """``(word, n, d0, d1, ...)``: per word (a hash) its occurrences and the sum of the index vectors within ``REACH`` words of them, over all texts.

    With ``only`` the words of these hashes (in order) have rows; all words count as neighbours.
    """
    names = ["n", *(f"d{i}" for i in range(DIMS))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pad = Words(only), np.zeros(REACH, np.int32)
        total = np.zeros((2 if only is None else len(only) + 1, DIMS + 1), np.int64)

        def add(ids: np.ndarray) -> None:
            nonlocal total
            known.settle()
            if only is None and len(total) <= len(known):
                total = np.concatenate((total, np.zeros((max(len(total), len(known)), DIMS + 1), np.int64)))
            n = len(ids) - 2 * REACH
            place = known.places[ids[REACH:REACH + n]]
            used = np.flatnonzero(place)
            if not len(used):
                return
            order = used[np.argsort(place[used], kind="stable")]
            vectors = known.index[ids]
            around = sum(vectors[s:s + n] for s in range(2 * REACH + 1) if s != REACH)  # at most 2 * REACH * NONZERO, so 8 bits hold it
            ordered = place[order]
            heads = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
            total[ordered[heads], 1:] += np.add.reduceat(around[order].astype(np.int32), heads, axis=0)
            total[ordered[heads], 0] += np.diff(np.append(heads, len(order)))

        def sums() -> pa.RecordBatch:
            used = np.flatnonzero(total[:, 0])
            hashes = known.hashes[used] if only is None else only[used - 1]
            return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), *(pa.array(total[used, i]) for i in range(DIMS + 1))], names=["word", *names])

        held, size = [pad], 0
        for batch in batches:
            for value in batch.column(0):
                ids = np.concatenate((known.numbers(value.as_py()), pad))
                for at in range(0, len(ids), WORDS_AT_ONCE):
                    held.append(ids[at:at + WORDS_AT_ONCE])
                    size += len(held[-1])
                    if size >= WORDS_AT_ONCE:
                        joined = np.concatenate(held)
                        add(joined)
                        held, size = [joined[-2 * REACH:]], 0  # the neighbourhood goes on there
                if len(known) >= WORDS_KEPT:  # between two texts
                    if size:
                        add(np.concatenate(held))
                    if only is None:
                        yield sums()
                        total = np.zeros((2, DIMS + 1), np.int64)
                    known, held, size = Words(only), [pad], 0
        if size:
            add(np.concatenate(held))
        yield sums()

    parts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, ", ".join(f"{n} long" for n in ["word", *names]))
    return parts.groupBy("word").agg(*[F.sum(n).alias(n) for n in names])


@dataclass
class Vectors:
    """Context vectors of unit length by word hash, hashes in order."""

    hashes: np.ndarray
    context: np.ndarray

    def of(self, words: Words, numbers: np.ndarray, dtype: type = np.float32) -> np.ndarray:
        """Index and context vectors of numbered words; zeros for the context of words without one.

        ``words`` that have their places among these hashes need not be looked up again.
        """
        found = np.empty((len(numbers), 2 * DIMS), dtype)
        np.divide(words.index[numbers], np.float32(np.sqrt(NONZERO)), out=found[:, :DIMS], dtype=np.float32)
        at = words.places[numbers] - 1 if words.only is self.hashes else positions(self.hashes, words.hashes[numbers])
        none = at < 0
        if len(self.hashes):
            found[:, DIMS:] = self.context[at]  # the last one stands in for none
        found[none, DIMS:] = 0
        return found


def word_vectors(docs: DataFrame, text_col: str = "text", least_share: float = LEAST_SHARE) -> Vectors:
    """The vectors of words that are at least ``least_share`` of all; there are at most ``1 / least_share``, so they may come to the driver.

    Words are counted first, so that tasks sum up and shuffle the contexts of these words alone.
    """
    counts = stage(word_counts(docs, text_col), "words")
    n = counts.agg(F.sum("n")).first()[0] or 0
    only = np.sort(counts.where(F.col("n") >= least_share * n).select("word").toArrow().column("word").to_numpy().view(np.uint64))
    table = context_sums(docs, text_col, only).drop("n").toArrow()
    hashes = table.column("word").to_numpy().view(np.uint64)
    context = np.stack([table.column(f"d{i}").to_numpy() for i in range(DIMS)], axis=1).astype(np.float64)
    context /= np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1.0)
    order = np.argsort(hashes)
    return Vectors(hashes[order], context[order].astype(np.float32))


def features(text: str | None, vectors: Vectors, words: Words) -> np.ndarray:
    """Mean and standard deviation of the vectors of a text's words; zeros without words."""
    return all_features([text], vectors, words)[0]


def all_features(texts: Iterable[str | None], vectors: Vectors, words: Words) -> np.ndarray:
    """A row of ``features`` per text; new words are entered for some texts at once."""
    rows, held = [], []

    def pool() -> None:
        words.settle()
        rows.extend(pooled(numbers, vectors, words) for numbers in held)
        held.clear()
        if len(words) >= WORDS_KEPT:
            words.clear()

    for text in texts:
        held.append(words.numbers(text))
        if len(words.fresh) >= FRESH_AT_ONCE or len(words) >= WORDS_KEPT or len(held) == TEXTS_AT_ONCE:
            pool()
    pool()
    return np.array(rows, np.float32).reshape(len(rows), INPUTS)


def pooled(numbers: np.ndarray, vectors: Vectors, words: Words) -> np.ndarray:
    numbers, counts = np.unique(numbers, return_counts=True)
    if not len(numbers):
        return np.zeros(INPUTS, np.float32)
    total = square = 0.0
    for at in range(0, len(numbers), WORDS_AT_ONCE):
        part, n = vectors.of(words, numbers[at:at + WORDS_AT_ONCE], np.float64), counts[at:at + WORDS_AT_ONCE]
        total, square = total + n @ part, square + n @ (part * part)
    mean = total / counts.sum()
    return np.concatenate((mean, np.sqrt(np.maximum(square / counts.sum() - mean * mean, 0)))).astype(np.float32)


@dataclass
class Network:
    """Inputs scaled to unit variance, one hidden layer of tanh, one logit over a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    last: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.hidden + self.bias) @ self.out + self.last

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def train(x: np.ndarray, y: np.ndarray, width: int = 32, rounds: int = 60, rate: float = 3e-3, decay: float = 1e-3, seed: int = 11) -> Network:
    """Fit by Adam on four fifths of the rows; the temperature minimises the log loss of the other fifth.

    Without rows, or with one label only, the scores are the smoothed share of label 1.
    """
    dims = x.shape[1]
    if len(y) < 20 or y.min() == y.max():
        share = (y.sum() + 1.0) / (len(y) + 2.0)
        return Network(np.zeros(dims), np.ones(dims), np.zeros((dims, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))
    draw = np.random.default_rng(seed)
    order = draw.permutation(len(y))
    aside, fit = order[: len(y) // 5], order[len(y) // 5:]
    mean, scale = x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-6
    net = Network(mean, scale, draw.normal(0, dims ** -0.5, (dims, width)), draw.normal(0, width ** -0.5, width), np.zeros(width), float(np.log(y[fit].mean() / (1 - y[fit].mean()))))
    weights = [net.hidden, net.bias, net.out, np.array([net.last])]
    slow, square, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    z = (x - mean) / scale
    for _ in range(rounds):
        for part in np.array_split(draw.permutation(fit), max(1, len(fit) // 128)):
            step += 1
            h = np.tanh(z[part] @ weights[0] + weights[1])
            error = (1 / (1 + np.exp(-np.clip(h @ weights[2] + weights[3][0], -40, 40))) - y[part]) / len(part)
            back = np.outer(error, weights[2]) * (1 - h * h)
            grads = [z[part].T @ back + decay * weights[0], back.sum(axis=0), h.T @ error + decay * weights[2], np.array([error.sum()])]
            for i, g in enumerate(grads):
                slow[i] = 0.9 * slow[i] + 0.1 * g
                square[i] = 0.999 * square[i] + 0.001 * g * g
                weights[i] -= rate * (slow[i] / (1 - 0.9 ** step)) / (np.sqrt(square[i] / (1 - 0.999 ** step)) + 1e-8)
    net.hidden, net.bias, net.out, net.last = weights[0], weights[1], weights[2], float(weights[3][0])
    logits, truth = net.logits(x[aside]), y[aside]
    loss = lambda t: np.logaddexp(0, -np.where(truth == 1, 1, -1) * logits / t).mean()
    net.temperature = float(min(np.geomspace(0.25, 10, 75), key=loss))
    return net


def held_out(id_col: Column) -> Column:
    """Rows no label may be learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score_column(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, id_col: str = "doc_id", text_col: str = "text",
                 least_share: float = LEAST_SHARE) -> Column:
    """The score of a text as a column over ``docs``, trained on ``labels`` (``doc_id``, ``quality``).

    Only texts enter a score. At most ``max_labelled`` labelled documents are learned from, those of the
    least hash of the id; documents with contrary labels count as label 0. Context sums cover all of ``docs``.
    """
    importable(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(word_vectors(docs, text_col, least_share))  # bounded by least_share

    known_labels = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    one_each = known_labels.groupBy("doc_id").agg(F.min("quality").cast("long").alias("quality"))
    sample = one_each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "doc_id")  # bounded by max_labelled

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words(shared.value.hashes)
        for batch in batches:
            rows = [x.tobytes() for x in all_features((v.as_py() for v in batch.column(1)), shared.value, known)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(rows, pa.binary())], names=["doc_id", "quality", "x"])

    texts = chosen.select("doc_id", "text", "quality").mapInArrow(measure, "doc_id long, quality long, x binary")
    one_row = texts.groupBy("doc_id").agg(F.min(F.struct("x", "quality")).alias("r")).select("doc_id", "r.x", "r.quality")  # repeated rows count once
    learned = sorted(one_row.collect())  # at most max_labelled rows of fixed size
    x = np.array([np.frombuffer(r[1], np.float32) for r in learned], np.float64).reshape(len(learned), INPUTS)
    net = train(x, np.array([r[2] for r in learned], np.float64))

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Words(shared.value.hashes)
        for texts in batches:
            x = all_features((t.as_py() for t in texts), shared.value, known)
            yield pa.array(net.scores(x.astype(np.float64)), pa.float64())

    return score(F.col(text_col))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on); columns of those names are replaced.

    Null and empty texts are scored like any other, from zero vectors. An empty table, or no labels,
    gives the same schema with scores that say nothing.
    """
    scored = docs.withColumn("score", score_column(docs, labels, **options))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
