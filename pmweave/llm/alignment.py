"""Cross-tokenizer alignment by pointer jumping, and how often two ids meet over the corpus.

Two tokenizers cut the same bytes. Every token points to the token of the other side that overlaps it
and reaches farthest right, or to itself where both end; following the pointers, doubled in
length each round, all tokens of a group arrive at the same last token, which names the group. That is
done for many texts at once on flat arrays of byte offsets.

Links between overlapping tokens are counted by id pair. Texts are put into blocks of a bounded number of
links; a block brings each of its pairs once to the corpus-wide count and gets it back once, so what
is shuffled are the distinct pairs of blocks, not the links of texts.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pmweave.llm.tokens import BYTE_LEVEL, OTHER_SCRIPTS, byte_level
from pmweave.llm.workers import importable
from pmweave.session import stage

CHARS_AT_ONCE = 1 << 19  # texts aligned together
BLOCK_LINKS = 1 << 21  # links of the texts of one block; a longer text is a block of its own
FIGURES = ["n_a", "n_b", "n_groups", "n_links"]


# ---- the two tokenizers

class ByteLevel:
    """A byte-level BPE ``.json`` file. Special strings in a text are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        shown = {c: b for b, c in _byte_characters().items()}
        self.pieces = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.pieces[i] = bytes(shown[c] for c in token) if all(c in shown for c in token) else token.encode()
        self.ranked = _ranked(path, self.pieces) if byte_level(path) else None

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Texts of scripts on whose character classes both libraries may differ go through the file's own library."""
        if self.ranked is None:
            return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        own = [OTHER_SCRIPTS.search(t) is not None for t in texts]
        rest = iter(self.library.encode_batch_fast([t for t, o in zip(texts, own, strict=True) if o], add_special_tokens=False))
        return [next(rest).ids if o else self.ranked.encode_ordinary(t) for t, o in zip(texts, own, strict=True)]


def _byte_characters() -> dict[int, str]:
    """How byte-level files write a byte: printable ones as they are, the others from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{b: chr(b) for b in plain}, **{b: chr(0x100 + i) for i, b in enumerate(others)}}


def _ranked(path: str, pieces: list[bytes]):
    """The same vocabulary for the faster library, where every merge makes the next id; else None."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    made = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    if any(model["vocab"].get(token) != 256 + i for i, token in enumerate(made)):
        return None
    ranks = {pieces[i]: i for i in range(256 + len(made))}
    pattern = BYTE_LEVEL.replace(r"\p{White_Space}", r"\s").replace(r"\P{White_Space}", r"\S")
    return tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Pieces:
    """A sentence-piece ``.model`` file, which puts the space in front itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        spelled = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.pieces = [bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in enumerate(spelled)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


@lru_cache(maxsize=4)
def tokenizers_of(a_path: str, b_path: str) -> tuple[ByteLevel, Pieces]:
    """Both tokenizers, loaded once per worker."""
    return ByteLevel(a_path), Pieces(b_path)


# ---- groups

def last_of_group(starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For every token, those of A before those of B, the B token that ends its group.

    Both sides cover the same bytes without gaps. A token of A points to the last token of B that begins
    before it ends; one of B to the last such token of A, or to itself where that one ends with it.
    """
    n_a = len(ends_a)
    to_b = np.searchsorted(starts_b, ends_a, "left") - 1 + n_a
    to_a = np.searchsorted(starts_a, ends_b, "left") - 1
    itself = np.arange(len(ends_b)) + n_a
    successor = np.concatenate((to_b, np.where(ends_a[to_a] > ends_b, to_a, itself)))
    while True:
        doubled = successor[successor]
        if np.array_equal(doubled, successor):
            return successor - n_a
        successor = doubled


@dataclass
class Aligned:
    """Some texts' tokens on flat arrays; ``at_a`` and ``at_b`` tell where each text's tokens begin, the end included."""

    a: np.ndarray
    b: np.ndarray
    at_a: np.ndarray
    at_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    at_group: np.ndarray
    left: np.ndarray  # the A token of every link
    right: np.ndarray
    at_link: np.ndarray

    def figures(self) -> np.ndarray:
        return np.stack([np.diff(x) for x in (self.at_a, self.at_b, self.at_group, self.at_link)], axis=1)


def _starts(lists: list[list[int]]) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))))


def align_texts(texts: list[str | None], a: ByteLevel, b: Pieces) -> Aligned:
    """Tokens, groups and links of ``texts``. A text that is null or empty, or that a side does not give back byte by byte, has none."""
    given = [t or "" for t in texts]
    ids_a, ids_b = a.encode([" " + t for t in given]), b.encode(given)
    for i, text in enumerate(given):
        whole = b" " + text.encode("utf-8", "surrogatepass")
        if not text or any(b"".join(map(side.pieces.__getitem__, ids)) != whole for side, ids in ((a, ids_a[i]), (b, ids_b[i]))):
            ids_a[i], ids_b[i] = [], []
    at_a, at_b = _starts(ids_a), _starts(ids_b)
    flat = [np.fromiter(chain.from_iterable(ids), np.int64, at[-1]) for ids, at in ((ids_a, at_a), (ids_b, at_b))]
    ends = [np.cumsum(_widths(side)[ids]) for side, ids in zip((a, b), flat, strict=True)]
    starts = [np.concatenate(([0], e[:-1])) if len(e) else e for e in ends]
    if not len(flat[0]):
        none = np.zeros(0, np.int64)
        nowhere = np.zeros(len(texts) + 1, np.int64)
        return Aligned(*flat, at_a, at_b, none, none, nowhere, none, none, nowhere)
    last = last_of_group(starts[0], ends[0], starts[1], ends[1])
    terminal = np.zeros(len(flat[1]), bool)
    terminal[last] = True
    rank = np.cumsum(terminal) - 1
    first = np.searchsorted(ends[1], starts[0], "right")
    reach = np.searchsorted(starts[1], ends[0], "left") - first
    before = np.concatenate(([0], np.cumsum(reach)))
    left = np.repeat(np.arange(len(reach)), reach)
    right = np.arange(before[-1]) - np.repeat(before[:-1], reach) + np.repeat(first, reach)
    at_group = np.concatenate(([0], np.cumsum(terminal)))[at_b]
    return Aligned(*flat, at_a, at_b, rank[last[:len(flat[0])]], rank[last[len(flat[0]):]], at_group, left, right, before[at_a])


def _widths(side) -> np.ndarray:
    if not hasattr(side, "widths"):
        side.widths = np.fromiter(map(len, side.pieces), np.int64, len(side.pieces))
    return side.widths


def group_texts(found: Aligned, a: ByteLevel, b: Pieces) -> Iterator[bytes]:
    """Per text its groups as ``a1,a2|b1;a3|b2,b3``: the ids of A, then those of B, group by group."""
    n = int(found.at_group[-1])
    in_a, in_b = np.bincount(found.group_a, minlength=n), np.bincount(found.group_b, minlength=n)
    place = np.zeros(len(found.a) + len(found.b), np.int64)
    codes = np.zeros(len(place), np.int64)
    closes_a = np.append(found.group_a[1:] != found.group_a[:-1], True)[:len(found.a)]
    closes_b = np.append(found.group_b[1:] != found.group_b[:-1], True)[:len(found.b)]
    ends_text = np.zeros(len(found.b), bool)
    ends_text[found.at_b[1:][np.diff(found.at_b) > 0] - 1] = True
    at_a = np.arange(len(found.a)) + (np.cumsum(in_b) - in_b)[found.group_a]
    at_b = np.arange(len(found.b)) + np.cumsum(in_a)[found.group_b]
    codes[at_a] = 2 * found.a + closes_a
    codes[at_b] = 2 * len(a.pieces) + 3 * found.b + closes_b + ends_text
    table = _spelled(len(a.pieces), len(b.pieces))
    spelled = list(map(table.__getitem__, codes.tolist()))
    whole = (found.at_a + found.at_b).tolist()
    for start, end in zip(whole[:-1], whole[1:], strict=True):
        yield b"".join(spelled[start:end])


@lru_cache(maxsize=2)
def _spelled(n_a: int, n_b: int) -> list[bytes]:
    """Ids in decimal with what may follow them: ``,`` or ``|`` for A, ``,``, ``;`` or nothing for B."""
    return [b"%d%s" % (i, mark) for i in range(n_a) for mark in (b",", b"|")] + [b"%d%s" % (i, mark) for i in range(n_b) for mark in (b",", b";", b"")]


# ---- the corpus

@dataclass
class _Block:
    """Texts gathered until their links are many enough; then a row each, the first with the block's distinct pairs."""

    number: int
    rows: list[tuple] = field(default_factory=list)
    pairs: list[np.ndarray] = field(default_factory=list)
    times: list[np.ndarray] = field(default_factory=list)
    links: int = 0

    def batch(self) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(self.pairs), return_counts=True)
        held = [_packed(np.searchsorted(keys, p)) for p in self.pairs]
        times = [_packed(t) for t in self.times]
        first = lambda values: pa.array([values] + [None] * (len(self.rows) - 1), pa.list_(pa.int64()))
        ids, groups, *figures = zip(*self.rows, strict=True)
        number = pa.array([self.number] * len(ids), pa.int64())
        return pa.RecordBatch.from_arrays(
            [number, pa.array(ids, pa.int64()), *(pa.array(f, pa.int64()) for f in figures), pa.array(groups, pa.string()),
             pa.array(held, pa.binary()), pa.array(times, pa.binary()), first(keys), first(counts)],
            names=["block", "id", *FIGURES, "groups", "held", "times", "keys", "texts"])


def _packed(numbers: np.ndarray) -> bytes:
    """Small or ascending numbers, as differences under zlib."""
    return zlib.compress(np.diff(numbers, prepend=0).astype("<i4").tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data), "<i4"), dtype=np.int64)


def _slices(batch: pa.RecordBatch, chars: int) -> Iterator[tuple[list, list]]:
    ids, texts, size = [], [], 0
    for i, text in zip(batch.column(0), batch.column(1), strict=True):
        ids.append(i.as_py())
        texts.append(text.as_py())
        size += len(texts[-1] or "")
        if size >= chars:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False,
          block_links: int = BLOCK_LINKS, chars: int = CHARS_AT_ONCE) -> DataFrame:
    """``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)`` per row.

    A is the byte-level file at ``a_path`` over a space and the text, B the sentence-piece file at ``b_path`` over the text. ``groups``
    is spelled ``a1,a2|b1;a3|b2,b3``, or with ``digest`` the SHA-256 of that. The count of an id pair is the number of
    rows that hold it linked; ``count_sum`` adds the counts over a row's links, and ``n_best`` counts the links
    whose count is the highest of their A id, ties included. Null and empty texts, and those that either side does not give
    back byte by byte, have no tokens: zeros and empty ``groups``. Repeated rows count as often as they occur and all
    come back, null ids too; no rows give no rows. Other columns are not looked at. Memory is bounded by one
    text, ``chars`` characters of others, and a block.
    """
    importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = tokenizers_of(a_path, b_path)
        number = TaskContext.get().partitionId() << 32
        block = _Block(number)
        for batch in batches:
            for ids, texts in _slices(batch, chars):
                found = align_texts(texts, a, b)
                pair = found.a[found.left] * len(b.pieces) + found.b[found.right]
                figures, at = found.figures().tolist(), found.at_link.tolist()
                for i, spelled in enumerate(group_texts(found, a, b)):
                    keys, times = np.unique(pair[at[i]:at[i + 1]], return_counts=True)
                    shown = hashlib.sha256(spelled).hexdigest() if digest and spelled else spelled.decode()
                    block.rows.append((ids[i], shown, *figures[i]))
                    block.pairs.append(keys)
                    block.times.append(times)
                    block.links += at[i + 1] - at[i]
                    if block.links >= block_links:
                        yield block.batch()
                        number += 1
                        block = _Block(number)
        if block.rows:
            yield block.batch()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    longs = ", ".join(f"{n} long" for n in FIGURES)
    texts = stage(rows.mapInArrow(run, f"block long, id long, {longs}, groups string, held binary, times binary, keys array<long>, texts array<long>"), "aligned")
    of_blocks = texts.where("keys is not null").select("block", F.explode(F.arrays_zip("keys", "texts")).alias("p")).select("block", "p.keys", "p.texts")
    known = stage(pair_counts(of_blocks, len_b(b_path)), "pairs")
    told = of_blocks.select(F.col("block").alias("of"), "keys").join(known, "keys").select("of", "keys", "n", "best")

    def tell(rows: pa.Table, pairs: pa.Table) -> pa.Table:
        order = np.argsort(pairs.column("keys").to_numpy())
        n, best = pairs.column("n").to_numpy()[order], pairs.column("best").to_numpy(zero_copy_only=False)[order]
        sums, bests = [], []
        for held, times in zip(rows.column("held"), rows.column("times"), strict=True):
            at, often = _unpacked(held.as_py()), _unpacked(times.as_py())
            sums.append(int((n[at] * often).sum()))
            bests.append(int(often[best[at]].sum()))
        kept = rows.select(["id", *FIGURES])
        return kept.append_column("n_best", pa.array(bests, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64())).append_column("groups", rows.column("groups"))

    shown = texts.select("block", "id", *FIGURES, "groups", "held", "times").groupBy("block")
    return shown.cogroup(told.groupBy("of")).applyInArrow(tell, f"id long, {longs}, n_best long, count_sum long, groups string")


@lru_cache(maxsize=4)
def len_b(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()


def pair_counts(of_blocks: DataFrame, n_b: int) -> DataFrame:
    """``(keys, n, best)``: in how many texts each id pair is linked, and whether no pair of its A id is in more."""
    counted = of_blocks.groupBy("keys").agg(F.sum("texts").alias("n")).withColumn("a", F.expr(f"keys div {n_b}"))
    most = counted.groupBy("a").agg(F.max("n").alias("most"))
    return counted.join(most, "a").select("keys", "n", (F.col("n") == F.col("most")).alias("best"))
