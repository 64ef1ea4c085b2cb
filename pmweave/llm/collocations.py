"""Collocations: phrases of 2 to 5 words that stick together, scored by their weakest cut.

Everything a phrase is scored with is a count of words in a row, and no part of a phrase is rarer than the
phrase. So words are counted first, then pairs of frequent words by hash, and only sequences whose words and
pairs may all be frequent are counted as they are: every shard builds two weighted automata of them
(``transducers``), one over the words in order and one over the words in reverse, the automata of all shards are united by range of prefixes, and one
path through a united automaton gives the weights of a phrase and of all its beginnings - in the reversed one, of all its ends.

What is known to be frequent goes to the tasks as bitmaps of a bounded size. They may hold a sequence too many, never one too
few; the counts that decide are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pmweave.llm import transducers
from pmweave.llm.transducers import Transducer
from pmweave.llm.workers import importable
from pmweave.session import stage

LEAST = 100
LONGEST = 5
CONTAINED_PERCENT = 100
TOP = 2000
UNKNOWN_LANG = "und"
SHARD_WORDS = 1 << 20  # words that are counted together
BYTES_AT_ONCE = 1 << 20
KNOWN_WORDS = 1 << 19  # distinct words a buffer numbers before it is counted and starts anew
RANGE_WORDS = 1 << 21  # words of the corpus per range of prefixes
MAX_RANGES = 1 << 13  # of one language
PARTS = 8  # a first word is spread over several ranges from an eighth of a range's words on
BITS_PER_KEY, LEAST_BITS, MOST_BITS = 16, 1 << 20, 1 << 26
PAGE_BITS = 1 << 15  # Spark's bitmaps
BREAK = b"."
# Upper to lower case of A-Z, and what ends a piece or a word.
LETTERS = bytes(range(65, 91)), bytes(range(97, 123))
ENDS = b".,;:!?\n\x0b\x0c\r"
TABLE = bytes.maketrans(LETTERS[0] + ENDS + b"\t", LETTERS[1] + BREAK * len(ENDS) + b" ")


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order with ``BREAK`` between pieces, in lists of bounded size."""
    plain = text.translate(TABLE)
    at = 0
    while at < len(plain):
        end = at + BYTES_AT_ONCE
        if end < len(plain):
            cuts = [x for x in (plain.find(b" ", end), plain.find(BREAK, end)) if x >= 0]
            end = min(cuts, default=len(plain))
        yield plain[at:end].replace(BREAK, b" . ").split()
        at = end


class Numbers(dict):
    """Words numbered in the order of their first occurrence."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


class Buffer:
    """The words of one language, gathered until there are many."""

    def __init__(self):
        self.numbers, self.parts, self.size = Numbers({BREAK: 0}), [], 0

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def full(self, shard_words: int) -> bool:
        return self.size >= shard_words or len(self.numbers) >= KNOWN_WORDS

    def drop(self, n: int) -> None:
        """The last ``n`` words, which came with the last call of ``add``, are not of this shard."""
        self.parts[-1] = self.parts[-1][:len(self.parts[-1]) - n]

    def line(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct words, ascending, and the text as their numbers, -1 for a break."""
        words = transducers.objects(list(self.numbers))
        order = np.argsort(words, kind="stable")
        order = order[order != 0]
        place = np.full(len(words), -1, np.int64)
        place[order] = np.arange(len(order))
        return words[order], place[np.concatenate(self.parts)]


def over_shards(count: Callable[[str, np.ndarray, np.ndarray], Iterator[pa.RecordBatch]], shard_words: int):
    """A function over batches of (lang, text as bytes) that hands the words of each language to ``count`` in shards.

    Shards end between texts, and within a long one at a break, so no phrase lies across two. Memory is bounded by a
    shard for each language and the longest run of words without a break.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffers: dict[str, Buffer] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                name = lang.as_py()
                for words in words_of(text.as_py()):
                    mine = buffers.setdefault(name, Buffer())
                    mine.add(words)
                    if mine.full(shard_words) and BREAK in words:
                        rest = words[len(words) - words[::-1].index(BREAK):]
                        mine.drop(len(rest))
                        yield from count(name, *buffers.pop(name).line())
                        buffers.setdefault(name, Buffer()).add(rest)
                if name in buffers:
                    buffers[name].add([BREAK])
                    if buffers[name].full(shard_words):
                        yield from count(name, *buffers.pop(name).line())
        for name, mine in buffers.items():
            yield from count(name, *mine.line())

    return run


def language_seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 42)


def word_hashes(lang: str, words: np.ndarray) -> np.ndarray:
    """As Spark's ``xxhash64(lang, word)``."""
    seed, digest = language_seed(lang), xxhash.xxh64_intdigest
    return np.fromiter((digest(w, seed) for w in words.tolist()), np.uint64, len(words))


def pair_hashes(hashes: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Of every place of ``line`` but the last with the next one; the places must hold words."""
    mixed = (hashes[line[:-1]] * np.uint64(0x9E3779B97F4A7C15)) ^ (hashes[line[1:]] + np.uint64(0x94D049BB133111EB))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


class Bitmap:
    """Keys by two bits of their hash each, as pages that Spark has put together."""

    def __init__(self, bits: int, pages: dict[int, bytes]):
        self.bits = bits
        self.cells = np.zeros(bits // 8, np.uint8)
        for page, data in pages.items():
            self.cells[page * (PAGE_BITS // 8):][: len(data)] = np.frombuffer(data, np.uint8)[: bits // 8]

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for shift in (0, 32):
            at = ((hashes >> np.uint64(shift)) & np.uint64(self.bits - 1)).astype(np.int64)
            found &= (self.cells[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return found


def bitmap_of(keys: DataFrame, hashed: str) -> Bitmap:
    """A bitmap of the longs in ``hashed``, of up to ``MOST_BITS`` bits; fuller ones only hold more keys too many."""
    wanted = BITS_PER_KEY * max(1, keys.count())
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (wanted - 1).bit_length()))
    position = F.explode(F.array(F.col(hashed).bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(hashed, 32).bitwiseAND(F.lit(bits - 1))))
    cells = keys.select(position.alias("p")).select(F.expr(f"p div {PAGE_BITS}").alias("page"), F.expr(f"p % {PAGE_BITS}").alias("p"))
    pages = cells.groupBy("page").agg(F.bitmap_construct_agg("p").alias("cells")).collect()  # at most MOST_BITS bits
    return Bitmap(bits, {r.page: bytes(r.cells) for r in pages})


class Ranges:
    """Ranges of prefixes of one language: by the hash of the first word, frequent first words over several by that of the second."""

    def __init__(self, lang: str, n: int, heavy: dict[bytes, int], range_words: int):
        self.seed, self.n = language_seed(lang), n
        self.count = ranges_for(n, range_words)
        self.heavy = {w: min(self.count, -(-often * self.count * PARTS // n)) for w, often in heavy.items()}

    def _hash(self, word: bytes) -> int:
        return xxhash.xxh64_intdigest(word, self.seed) >> 16

    def __call__(self, first: np.ndarray, second: np.ndarray | None) -> np.ndarray:
        if second is None:
            return np.fromiter((-1 if w in self.heavy else self._hash(w) % self.count for w in first.tolist()), np.int64, len(first))
        places = ((self._hash(a) + self._hash(b) % self.heavy[a]) % self.count for a, b in zip(first.tolist(), second.tolist(), strict=True))
        return np.fromiter(places, np.int64, len(first))

    def spread(self, word: bytes) -> set[int]:
        return {(self._hash(word) + i) % self.count for i in range(self.heavy[word])}


def ranges_for(n: int, range_words: int) -> int:
    return min(MAX_RANGES, 1 + n // range_words)


def frequent_words(texts: DataFrame, shard_words: int) -> DataFrame:
    """``(lang, word, n)``, the words as bytes."""

    def count(lang: str, words: np.ndarray, line: np.ndarray) -> Iterator[pa.RecordBatch]:
        n = np.bincount(line[line >= 0], minlength=len(words))
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), pa.array(words.tolist(), pa.binary()), pa.array(n, pa.int64())], names=["lang", "word", "n"])

    parts = texts.mapInArrow(over_shards(count, shard_words), "lang string, word binary, n long")
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def frequent_pairs(texts: DataFrame, words_held, least: int, shard_words: int) -> DataFrame:
    """Hashes of the pairs of words that may occur ``least`` times."""

    def count(lang: str, words: np.ndarray, line: np.ndarray) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes(lang, words)
        kept = np.append(words_held.value.holds(hashes), False)[line]  # a break reads the last place
        both = kept[:-1] & kept[1:]
        pairs, n = np.unique(pair_hashes(hashes, np.where(line < 0, 0, line))[both] if len(words) else np.zeros(0, np.uint64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(pairs.view(np.int64)), pa.array(n, pa.int64())], names=["pair", "n"])

    parts = texts.mapInArrow(over_shards(count, shard_words), "pair long, n long")
    return parts.groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("pair")


def shard_transducers(texts: DataFrame, words_held, pairs_held, ranges, longest: int, shard_words: int) -> DataFrame:
    """A row per shard, direction and range of prefixes: ``(lang, reverse, range, ...)`` with the automaton's arrays."""
    names = ["lang", "reverse", "range", *(n for n, _ in transducers.ARROW)]

    def count(lang: str, words: np.ndarray, line: np.ndarray) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes(lang, words)
        line = np.where(np.append(words_held.value.holds(hashes), False)[line], line, -1)
        joined = (line[:-1] >= 0) & (line[1:] >= 0)
        joined[joined] = pairs_held.value.holds(pair_hashes(hashes, np.where(line < 0, 0, line))[joined])
        for reverse, way in ((False, slice(None)), (True, slice(None, None, -1))):
            built = transducers.build(words, line[way], joined[way], longest)
            for place, part in transducers.by_prefix(built, ranges.value[lang]).items():
                columns = part.arrow()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([reverse]), pa.array([place], pa.int64()), *(pa.array([columns[n]], kind) for n, kind in transducers.ARROW)], names=names)

    return texts.mapInArrow(over_shards(count, shard_words), f"lang string, reverse boolean, range long, {transducers.SCHEMA}")


UNITED_AT_ONCE = 1 << 20  # states


def counted_phrases(shards: DataFrame, ranges, least: int) -> DataFrame:
    """``(lang, reverse, phrase, weights, n)``: sequences of 2 words and more of at least ``least``, in reading order, with the weights of
    all their beginnings - with ``reverse`` of all their ends - from one word on, and the words of the language. A range is united in
    one task, some automata at a time."""

    def emit(key: tuple, whole: Transducer) -> Iterator[pa.RecordBatch]:
        lang, reverse, _ = key
        for level in range(1, len(whole.weights)):
            labels, weights = transducers.paths(whole, level, least)
            if not len(labels):
                continue
            spelled = whole.words[labels[:, ::-1] if reverse else labels]
            phrases = [b" ".join(row) for row in spelled.tolist()]
            n = len(phrases)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * n, pa.string()), pa.array([reverse] * n), pa.array(phrases, pa.binary()),
                 pa.array(weights.tolist(), pa.list_(pa.int64())), pa.array([ranges.value[lang].n] * n, pa.int64())],
                names=["lang", "reverse", "phrase", "weights", "n"])

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, some, size = None, [], 0
        for batch in batches:
            for row in range(batch.num_rows):
                lang, reverse, place, *arrays = (c[row] for c in batch.columns)
                mine = lang.as_py(), reverse.as_py(), place.as_py()
                if mine != key:
                    if some:
                        yield from emit(key, transducers.united(some))
                    key, some, size = mine, [], 0
                some.append(transducers.from_arrow(*arrays))
                size += len(some[-1])
                if len(some) > 1 and size > UNITED_AT_ONCE + 2 * len(some[0]):
                    some = [transducers.united(some)]
                    size = len(some[0])
        if some:
            yield from emit(key, transducers.united(some))

    group = ["lang", "reverse", "range"]
    dealt = shards.repartition(*group).sortWithinPartitions(*group)
    return dealt.mapInArrow(unite, "lang string, reverse boolean, phrase binary, weights array<bigint>, n long")


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST, contained_percent: int = CONTAINED_PERCENT,
         shard_words: int = SHARD_WORDS, range_words: int = RANGE_WORDS) -> DataFrame:
    """Candidate phrases with ``lang, phrase, a, l, r, n, score``, those inside a longer one left out.

    Words are what lies between blanks of the pieces between ``.,;:!?`` and line ends, A-Z in lower case. All is counted per language, a
    null one being ``und``: ``n`` words, ``a`` occurrences of the phrase within pieces, overlaps included. A phrase of at least ``least``
    occurrences is cut into its first words, ``l``, and the rest, ``r``, where floor(1000 * a * n / (l * r)) is lowest, the earliest
    of such cuts. A phrase within a longer candidate that occurs ``contained_percent`` per cent as often is left out. Null and empty texts hold
    nothing; repeated rows count as often as they occur; no rows give no rows; other columns are not looked at. The driver holds a row for
    each language, the first words that are more than a range of prefixes, and two bitmaps of a bounded size.
    """
    spark = importable(docs.sparkSession).sparkContext
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"), text.alias("text"))
    words = stage(frequent_words(texts, shard_words), "words")
    totals = {r.lang: r.n for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    often = stage(words.where(F.col("n") >= least), "frequent")
    heavy: dict[str, dict[bytes, int]] = {lang: {} for lang in totals}
    shares = docs.sparkSession.createDataFrame([(lang, n // (PARTS * ranges_for(n, range_words))) for lang, n in totals.items()], "lang string, share long")
    for r in often.join(shares, "lang").where("n > share").collect():  # of a language at most PARTS times its ranges
        heavy[r.lang][bytes(r.word)] = r.n
    ranges = spark.broadcast({lang: Ranges(lang, n, heavy[lang], range_words) for lang, n in totals.items()})
    words_held = spark.broadcast(bitmap_of(often.select(F.xxhash64("lang", "word").alias("h")), "h"))
    pairs = stage(frequent_pairs(texts, words_held, least, shard_words), "pairs")
    pairs_held = spark.broadcast(bitmap_of(pairs, "pair"))
    shards = shard_transducers(texts, words_held, pairs_held, ranges, longest, shard_words)
    counted = stage(counted_phrases(shards, ranges, least), "phrases")
    ends = counted.where("reverse").select("lang", "phrase", F.col("weights").alias("ends"))
    return _scored(counted.where("not reverse").join(ends, ["lang", "phrase"]), contained_percent)


def _scored(counted: DataFrame, contained_percent: int) -> DataFrame:
    """``mine`` from ``(lang, phrase, weights, ends, n)``, the weights of all beginnings and ends of each phrase."""
    size = F.size("weights")
    rows = counted.select("lang", F.col("phrase").cast("string").alias("phrase"), F.get("weights", size - 1).alias("a"), "weights", "ends", "n")
    number = lambda c: c.cast("decimal(19,0)")
    cuts = F.transform(F.sequence(F.lit(1), size - 1), lambda k: F.struct(
        k.alias("k"), F.get("weights", k - 1).alias("l"), F.get("ends", size - k - 1).alias("r")))
    rows = rows.select("lang", "phrase", "a", "n", F.explode(cuts).alias("cut")).select("lang", "phrase", "a", "n", "cut.*")
    rows = rows.withColumns({"top": F.lit(1000).cast("decimal(4,0)") * number(F.col("a")) * number(F.col("n")), "under": number(F.col("l")) * number(F.col("r"))})
    rows = rows.withColumn("score", F.expr("top div under"))
    lowest = F.min(F.struct("score", "k", "l", "r", "n", "a")).alias("c")
    candidates = stage(rows.groupBy("lang", "phrase").agg(lowest).select("lang", "phrase", "c.a", "c.l", "c.r", "c.n", "c.score"), "candidates")
    words = F.split("phrase", " ")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size("words") - 1), lambda k: F.transform(
        F.sequence(F.lit(1), F.size("words") - k + 1), lambda at: F.array_join(F.slice("words", at, k), " "))))
    longer = candidates.withColumn("words", words).where(F.size("words") > 2)
    within = longer.select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left_out = F.coalesce(100 * F.col("longer") >= contained_percent * F.col("a"), F.lit(False))
    return candidates.join(within, ["lang", "phrase"], "left").where(~left_out).select("lang", "phrase", "a", "l", "r", "n", "score")


def best(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language with their ``rank`` from 1: by score, then count, both descending, then by the phrase's bytes."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
