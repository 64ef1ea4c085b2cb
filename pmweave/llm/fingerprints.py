"""SimHash fingerprints of whole texts, computed a batch of rows at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

SHINGLE_WORDS = 4
SEED = 42
WIDE = ["fp", "more", "most"]  # columns of a wide fingerprint, 64 bits each
HASHES_AT_ONCE = 1 << 16  # bounds the memory of one very long text


def shingle_hashes(text: str | None, words_each: int = SHINGLE_WORDS, seed: int = SEED) -> Iterator[np.ndarray]:
    """XXH64 of every word shingle, repeats included, in bounded arrays.

    ``bytes.lower`` and ``bytes.split`` touch exactly A-Z and the six ASCII blanks, so no
    character table is needed. A text of fewer words is one shingle; one of none has none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(words_each, len(words))
    spans = list(zip(starts[: len(words) - width + 1].tolist(), ends[width - 1:].tolist(), strict=True))
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(spans), HASHES_AT_ONCE):
        part = spans[at: at + HASHES_AT_ONCE]
        yield np.fromiter((digest(joined[a:b], seed) for a, b in part), "<u8", len(part))


def simhash(text: str | None, words_each: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes; zero without words."""
    ones, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, words_each, seed):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]) if n else 0


def add_fingerprints(batches: Iterator[pa.RecordBatch], words_each: int = SHINGLE_WORDS) -> Iterator[pa.RecordBatch]:
    """Rows of (id, text) to rows of (id, fp), the 64 bits held in a signed long."""
    for batch in batches:
        found = np.fromiter((simhash(t.as_py(), words_each) for t in batch.column(1)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])


def majority(hashes: np.ndarray) -> np.uint64:
    """A bit is 1 if it is set in over half of ``hashes``; zero without any."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        part = np.ascontiguousarray(hashes[at: at + HASHES_AT_ONCE])
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0]


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Other hashes of the same shingles (the finalizer of splitmix64)."""
    h = hashes + np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def set_name(shingles: np.ndarray) -> bytes:
    """128 bits that are equal for equal shingle sets."""
    return xxhash.xxh3_128_digest(shingles.tobytes())


def add_wide_fingerprints(batches: Iterator[pa.RecordBatch], words_each: int) -> Iterator[pa.RecordBatch]:
    """Rows of (id, text) to rows of (id, same, *WIDE): the name of the set of distinct shingles, and its 192 bits in three signed longs."""
    for batch in batches:
        same, thirds = [], np.zeros((len(WIDE), batch.num_rows), np.uint64)
        for i, text in enumerate(batch.column(1)):
            shingles = shingle_set(text.as_py(), words_each)
            same.append(set_name(shingles))
            for third in thirds:
                third[i] = majority(shingles)
                shingles = mixed(shingles)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(same, pa.binary()), *(pa.array(t.view(np.int64)) for t in thirds)], names=["id", "same", *WIDE])


def shingle_set(text: str | None, words_each: int) -> np.ndarray:
    """The distinct shingle hashes of a text in ascending order."""
    parts = [np.unique(h) for h in shingle_hashes(text, words_each)]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
