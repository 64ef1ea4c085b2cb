"""Language identification by mixture inference over character n-grams.

Every learned language is a distribution over letter trigrams. A text is taken as a mixture of languages:
expectation-maximisation estimates the share of each from the likelihoods of its trigrams, and the
set of languages grows greedily, by the one that would raise the likelihood fastest, as long as the log-likelihood
gains more than the penalty of another share. The language of the largest share is the prediction.

Trigrams are hashed into a fixed number of cells, so the table that goes to the tasks has ``CELLS`` numbers
per learned language whatever the corpus; the counts in it are those of all texts that may be learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pmweave.llm.workers import importable

CELLS = 1 << 17
WIDTH = 3
SMOOTHING = 0.5
PENALTY = 3.0  # log-likelihood asked per doubling of the trigrams before a text gets one language more
MAX_STEPS = 40
SETTLED = 1e-4  # no share moves more than this in the last step
CHARS_AT_ONCE = 1 << 20
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether a code point is a letter (any Unicode category L)."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def cells_of(text: str) -> np.ndarray:
    """The cells of the letter trigrams of a text in lower case, what is no letter being one blank; a trigram has a letter in the middle."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    is_letter = letters()[points]
    held = is_letter.copy()
    held[1:] |= is_letter[:-1]  # the first blank after a letter stays
    line = np.concatenate(([0], np.where(is_letter, points, 0)[held], [0])).astype(np.uint64)
    middle = line[1:-1] != 0
    packed = (line[:-2] << np.uint64(42) | line[1:-1] << np.uint64(21) | line[2:])[middle]
    return ((packed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def counted_cells(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct cells of a text and how often each occurs; none for a text without letters. A long text is read in parts."""
    total: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    text = text or ""
    for at in range(0, len(text), CHARS_AT_ONCE):
        # parts share the characters whose trigram crosses the cut, each trigram being counted where its middle lies
        part = cells_of(text[at:at + CHARS_AT_ONCE]) if len(text) <= CHARS_AT_ONCE else _inner_cells(text, at)
        cells, times = np.unique(part, return_counts=True)
        if len(total[0]):
            both = np.concatenate((total[0], cells))
            names, place = np.unique(both, return_inverse=True)
            total = names, np.bincount(place, np.concatenate((total[1], times)), len(names)).astype(np.int64)
        else:
            total = cells, times
    return total


def _inner_cells(text: str, at: int) -> np.ndarray:
    """The cells of one part of a long text, cut behind the first blank within it and the next part's first blank."""
    start = at if at == 0 else _next_blank(text, at)
    end = len(text) if at + CHARS_AT_ONCE >= len(text) else _next_blank(text, at + CHARS_AT_ONCE)
    return cells_of(text[start:end])


def _next_blank(text: str, at: int) -> int:
    """The next character from ``at`` on that is no letter, looked for within one part; a longer word is cut."""
    return next((i for i in range(at, min(len(text), at + CHARS_AT_ONCE)) if not text[i].isalpha()), min(len(text), at + CHARS_AT_ONCE))


def trigram_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(lang, cell, n)`` over all rows with a language: tasks count cells in arrays, one grouped sum adds them up."""
    importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                cells, times = counted_cells(text.as_py())
                mine = totals.setdefault(lang.as_py(), np.zeros(CELLS, np.int64))
                mine[cells] += times
        for lang, counts in totals.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(counts[used])], names=["lang", "cell", "n"])

    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang is not null")
    return rows.mapInArrow(run, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))


class Languages:
    """Smoothed trigram likelihoods, a row per cell and a column per language in code point order."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        smoothed = counts.astype(np.float64) + SMOOTHING
        self.likelihood = (smoothed / smoothed.sum(axis=0, keepdims=True)).astype(np.float32) if names else smoothed.astype(np.float32)

    def shares(self, cells: np.ndarray, times: np.ndarray) -> dict[str, float]:
        """The selected languages of a text with their estimated shares, which add up to 1."""
        likely = self.likelihood[cells].astype(np.float64)
        n = times.sum()
        price = PENALTY * np.log2(max(n, 2))
        alone = times @ np.log(likely)
        chosen = [int(np.argmax(alone))]
        share, best = np.ones(1), float(alone[chosen[0]])
        while len(chosen) < len(self.names):
            mixed = likely[:, chosen] @ share
            pull = (times / mixed) @ likely / n  # above 1 where a little of the language would help
            pull[chosen] = 0
            new = int(np.argmax(pull))
            if pull[new] <= 1:
                break
            grown, value = balance(likely[:, [*chosen, new]], times)
            if value - best <= price:
                break
            chosen, share, best = [*chosen, new], grown, value
        return {self.names[i]: float(s) for i, s in zip(chosen, share, strict=True)}

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language of the largest share and that share; ties go to the first name. ``und`` and 0 without a letter or a learned language."""
        cells, times = counted_cells(text)
        if not len(cells) or not self.names:
            return UNDETERMINED, 0.0
        share = self.shares(cells, times)
        name = min(share, key=lambda k: (-share[k], k))
        return name, min(1.0, share[name])


def balance(likely: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares by expectation-maximisation from equal ones, and the log-likelihood they give."""
    n, share = times.sum(), np.full(likely.shape[1], 1 / likely.shape[1])
    for _ in range(MAX_STEPS):
        joint = likely * share
        following = times @ (joint / joint.sum(axis=1, keepdims=True)) / n
        moved = np.abs(following - share).max()
        share = following
        if moved < SETTLED:
            break
    return share, float(times @ np.log(likely @ share))


def learned(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Languages:
    """The likelihoods of all languages that a row of ``docs`` names; the driver gets at most ``CELLS`` counts of each."""
    table = trigram_counts(docs, text_col, lang_col).toArrow()
    names = sorted(set(table.column("lang").to_pylist()), key=lambda x: x.encode())
    counts = np.zeros((CELLS, len(names)), np.int64)
    place = {x: i for i, x in enumerate(names)}
    lang = np.fromiter(map(place.__getitem__, table.column("lang").to_pylist()), np.int64, table.num_rows)
    counts[table.column("cell").to_numpy(), lang] = table.column("n").to_numpy()
    return Languages(names, counts)


def held_out(id_col: Column) -> Column:
    """Rows that nothing may be learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, training: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (the share of that language) and ``shares``, the selected languages as a map.

    The languages are those that ``lang_col`` of ``training`` names, learned from all its rows; a null names none. Only the text enters a
    prediction. A null text, or one without a letter, gets ``und``, 0 and an empty map, and so does every text where no language was
    learned. A column of ``docs`` with one of the new names is replaced; repeated rows and null ids stay; no rows give no rows.
    Texts are measured whole, a part at a time.
    """
    importable(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(learned(training, text_col, lang_col))  # CELLS numbers per language

    @F.arrow_udf("struct<lang_pred: string, score: double, shares: map<string, double>>")
    def mixture(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: Languages = shared.value
        for texts in batches:
            rows = []
            for text in texts:
                cells, times = counted_cells(text.as_py())
                share = known.shares(cells, times) if len(cells) and known.names else {}
                name = min(share, key=lambda k: (-share[k], k)) if share else UNDETERMINED
                rows.append({"lang_pred": name, "score": min(1.0, share.get(name, 0.0)), "shares": list(share.items())})
            kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("shares", pa.map_(pa.string(), pa.float64()))])
            yield pa.array(rows, kind)

    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "shares")]
    found = mixture(F.col(text_col).cast("string"))
    inside = "_" * (1 + max(map(len, docs.columns))) + "found"  # longer than any name, so it clashes with none
    return docs.select(*[F.col(f"`{c}`") for c in kept], found.alias(inside)).select(*[F.col(f"`{c}`") for c in kept], f"{inside}.*")
