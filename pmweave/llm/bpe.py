"""Byte-level BPE by a rank file: texts to ids and back.

Texts are cut into overlapping chunks, a row each, pre-tokenised in parallel, stitched where their pre-token
borders fall together, and the pieces are encoded one by one; ids are kept as little-endian 32-bit numbers.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from pmweave.llm import splicing
from pmweave.llm.splicing import GUARD, spliced
from pmweave.llm.workers import importable

CHUNK = 1 << 12  # characters
OVERLAP = 1 << 8
MAX_CHUNK = (1 << 15) - 1  # a chunk with its overlap has less than 65,536 characters, so widths fit 16 bits
ROWS_AT_ONCE = 256
PIECES_KEPT = 1 << 17
PIECE_CHARS = 64  # longer pre-tokens are not remembered
_encodings: dict[tuple[str, str], object] = {}


def encoding(path: str, pattern: str):
    """The vocabulary of a rank file, loaded once per worker."""
    if (path, pattern) not in _encodings:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _encodings[path, pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path, pattern]


def packed(data: bytes) -> bytes:
    """Zstandard with the size in front; what is shuffled twice is packed once."""
    return len(data).to_bytes(4, "little") + pa.Codec("zstd").compress(data, asbytes=True)


def unpacked(data: bytes) -> bytes:
    return pa.Codec("zstd").decompress(data[4:], int.from_bytes(data[:4], "little"), asbytes=True)


@lru_cache(maxsize=8)
def splitter(pattern: str):
    # \s of the rank files' library is the Unicode property; here it would take four control characters more
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


class Pieces(dict):
    """Pre-token to its ids, little-endian 32-bit; remembered up to a bound."""

    def __init__(self, path: str, pattern: str):
        self.encode = encoding(path, pattern)._encode_single_piece

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= PIECES_KEPT:
            self.clear()
        found = np.array(self.encode(piece), "<u4").tobytes()
        if len(piece) <= PIECE_CHARS:
            self[piece] = found
        return found


def encode_long(path: str, pattern: str, text: str, chunk: int = splicing.CHUNK, overlap: int = splicing.OVERLAP) -> bytes:
    """Ids of one text in one task, chunk after chunk, overlaps widened until borders meet."""
    known = Pieces(path, pattern)

    def split(part: str) -> tuple[list[int], list[str]]:
        pieces = splitter(pattern).findall(part)
        return np.cumsum([0, *map(len, pieces)]).tolist(), pieces

    out = bytearray()
    for pieces, first, last in spliced(text, split, chunk, overlap):
        out += b"".join(map(known.__getitem__, pieces[first:last]))
    return bytes(out)


def chunks(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """``(row, document, text)`` rows as ``(row, k, document, text)``: chunk ``k`` begins at ``k * chunk`` and reaches ``overlap`` into the next.

    The last ends the text. Only the first brings the ``document`` along. Texts of chunks are packed UTF-8.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, ks, parts = [], [], []
            for i, value in enumerate(batch.column("text")):
                text = value.as_py()
                for k in range(max(1, -((overlap - len(text)) // chunk))):
                    at.append(i)
                    ks.append(k)
                    parts.append(packed(text[k * chunk:(k + 1) * chunk + overlap].encode()))
                    if len(parts) == ROWS_AT_ONCE:
                        yield rows(batch, at, ks, parts)
                        at, ks, parts = [], [], []
            if parts:
                yield rows(batch, at, ks, parts)

    def rows(batch: pa.RecordBatch, at: list[int], ks: list[int], parts: list[bytes]) -> pa.RecordBatch:
        first = pa.array([None if k else i for i, k in zip(at, ks, strict=True)], pa.int64())
        return pa.RecordBatch.from_arrays([
            batch.column("row").take(pa.array(at, pa.int64())), pa.array(ks, pa.int32()), batch.column("document").take(first), pa.array(parts, pa.binary()),
        ], names=["row", "k", "document", "text"])

    return long.select("row", "document", "text").mapInArrow(cut, _schema(long, "row long, k int", "text binary"))


def _schema(rows: DataFrame, before: str, after: str) -> StructType:
    """Columns, the ``document`` of ``rows``, and more columns."""
    document = StructField("document", rows.schema["document"].dataType)
    return StructType([*(StructType.fromDDL(before) if before else []), document, *StructType.fromDDL(after)])


def common_border(earlier: np.ndarray, later: np.ndarray, chunk: int, end: int) -> tuple[int, int] | None:
    """Where two neighbouring chunks surely agree: the last border that both have, as its number in each.

    Borders count from the beginning of their own chunk, ``chunk`` apart; those of the earlier one's last ``GUARD`` characters prove nothing.
    """
    both, i, j = np.intersect1d(earlier, later + chunk, assume_unique=True, return_indices=True)
    proven = np.flatnonzero(both <= end - GUARD)
    return (int(i[proven[-1]]), int(j[proven[-1]])) if len(proven) else None


def stitched(parts: list[str], borders: list[np.ndarray], chunk: int, path: str, pattern: str, known: Pieces) -> bytes:
    """Ids of a text from its pre-tokenised chunks.

    The first chunk's borders are true, and from a border that a chunk shares with the next on, so are the next one's.
    Every two neighbours are joined by themselves, as overlaps do not meet. Where two have no common border, as inside a
    pre-token longer than the overlap, the whole text is read again with growing overlaps.
    """
    out, first = [], 0
    for k, (part, ends) in enumerate(zip(parts, borders, strict=True)):
        joined = (len(ends) - 1, 0) if k + 1 == len(parts) else common_border(ends, borders[k + 1], chunk, len(part))
        if joined is None:
            return encode_long(path, pattern, "".join(p[:chunk] for p in parts[:-1]) + parts[-1])
        cuts = ends[first:joined[0] + 1].tolist()
        out += [known[part[a:b]] for a, b in zip(cuts, cuts[1:], strict=False)]
        first = joined[1]
    return b"".join(out)


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP,
           decoded: bool = False) -> DataFrame:
    """``docs`` without its text, with ``n_tokens`` and ``ids`` (binary); a null text has no tokens.

    Texts of over ``chunk`` characters become rows of overlapping chunks that are dealt out and pre-tokenised on all tasks, come together by
    text, are stitched where their borders resynchronise, and then their pieces are encoded. A shorter text is one chunk.
    With ``decoded`` the ids are also turned back, in the same task, as ``decode`` would.
    Special strings are ordinary text. Columns named like the new ones are replaced; repeated rows stay;
    an empty table stays empty. A task holds one text at a time besides its Arrow batch.
    """
    if not GUARD < overlap <= chunk <= MAX_CHUNK:
        raise ValueError(f"the overlap must be over {GUARD} and at most the chunk, the chunk at most {MAX_CHUNK}")
    importable(docs.sparkSession)
    added = ["n_tokens", "ids", *(["decoded"] if decoded else [])]
    kept = [c for c in docs.columns if c not in (text_col, *added)]
    document = F.struct(F.lit(True).alias("any"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)])
    rows = docs.select(F.monotonically_increasing_id().alias("row"), document.alias("document"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = _schema(rows, "", "n_tokens long, ids binary" + (", decoded binary" if decoded else ""))

    def finished(documents: pa.Array, ids: list[bytes]) -> pa.RecordBatch:
        back = [pa.array([decode_one(path, pattern, x) for x in ids], pa.binary())] if decoded else []
        counts = pa.array([len(x) // 4 for x in ids], pa.int64())
        return pa.RecordBatch.from_arrays([documents, counts, pa.array(ids, pa.binary()), *back], names=["document", *added])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, split = Pieces(path, pattern), splitter(pattern).findall
        for batch in batches:
            yield finished(batch.column("document"), [b"".join(map(known.__getitem__, split(t.as_py()))) for t in batch.column("text")])

    def pretokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter(pattern).findall
        for batch in batches:
            widths = [packed(np.fromiter(map(len, split(unpacked(t.as_py()).decode())), "<u2").tobytes()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(widths, pa.binary())], names=["row", "k", "document", "text", "widths"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, now, head, parts, borders, documents, ids = Pieces(path, pattern), None, None, [], [], [], []
        for batch in batches:
            for i, (row, text, widths) in enumerate(zip(batch.column("row").to_pylist(), batch.column("text"), batch.column("widths"), strict=True)):
                if row != now:
                    if parts:
                        documents.append(head)
                        ids.append(stitched(parts, borders, chunk, path, pattern, known))
                    now, head, parts, borders = row, batch.column("document").slice(i, 1), [], []
                parts.append(unpacked(text.as_py()).decode())
                borders.append(np.concatenate(([0], np.cumsum(np.frombuffer(unpacked(widths.as_py()), "<u2"), dtype=np.int64))))
            if documents:
                yield finished(pa.concat_arrays(documents), ids)
                documents, ids = [], []
        if parts:
            yield finished(head, [stitched(parts, borders, chunk, path, pattern, known)])

    short = rows.where(F.length("text") <= chunk).mapInArrow(whole, schema)
    dealt = chunks(rows.where(F.length("text") > chunk), chunk, overlap).repartition("row", "k")
    split_up = dealt.mapInArrow(pretokenise, _schema(rows, "row long, k int", "text binary, widths binary"))
    long = split_up.repartition("row").sortWithinPartitions("row", "k").mapInArrow(join, schema)
    return short.unionAll(long).select(*[F.col(f"document.c{i}").alias(c) for i, c in enumerate(kept)], *added)


def decode_one(path: str, pattern: str, ids: bytes | None) -> bytes:
    return encoding(path, pattern).decode_bytes(np.frombuffer(ids or b"", "<u4").tolist())


def decode(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the raw bytes of the ids, one after another.

    Null and empty ids decode to nothing, a column ``decoded`` is replaced, repeated rows stay, an empty table stays empty.
    """
    importable(encoded.sparkSession)
    kept = [c for c in encoded.columns if c != "decoded"]
    rows = encoded.select(*kept)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields] + ["decoded binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [decode_one(path, pattern, v.as_py()) for v in batch.column(kept.index(ids_col))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=[*kept, "decoded"])

    return rows.mapInArrow(run, schema)
