"""Token counts of whole texts, huge ones in overlapping chunks joined where both agree."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pmweave.llm.splicing import CHUNK, OVERLAP, spliced
from pmweave.llm.workers import importable

CHARS_AT_ONCE = 1 << 19  # texts handed to the tokenizer together
PIECES_KEPT, PIECE_CHARS = 1 << 19, 64  # pre-tokens of up to so many characters whose counts a worker remembers; beyond it the memory starts anew
# Fixed value: the pre-tokens of byte-level tokenizers, \s written as the property that it stands for in their library.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
PRE_TOKENS = regex.compile(BYTE_LEVEL)
OTHER_SCRIPTS = regex.compile(r"[^\x00-\u024f]")  # Unicode versions agree on the classes of what is left
_loaded: dict[str, object] = {}
_known: dict[str, dict[str, int]] = {}


def tokenizer(path: str):
    """The tokenizer of a .json file, loaded once per worker."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives every core a task already
        from tokenizers import Tokenizer

        _loaded[path] = Tokenizer.from_file(path)
    return _loaded[path]


@lru_cache(maxsize=8)
def byte_level(path: str) -> bool:
    """Whether texts are cut by ``BYTE_LEVEL`` and nothing else, so that pre-tokens can be counted one by one."""
    spec = json.loads(tokenizer(path).to_str(pretty=False).split('"model":', 1)[0].rstrip(", ") + "}")
    pre = spec["pre_tokenizer"] or {}
    return (pre.get("type"), pre.get("use_regex"), pre.get("add_prefix_space"), spec["normalizer"]) == ("ByteLevel", True, False, None)


def count_short(path: str, texts: list[str], cut: bool) -> list[int]:
    """Tokens of each text. Pre-tokens recur, so their counts are looked up and the library encodes new ones only.

    Texts with other scripts or with a special string go to the library whole, and so do all where ``cut`` is false.
    """
    library = tokenizer(path)
    special = [t.content for t in library.get_added_tokens_decoder().values()]
    known = _known.setdefault(path, {})
    if len(known) > PIECES_KEPT:
        known.clear()
    whole = [not cut or OTHER_SCRIPTS.search(t) is not None or any(x in t for x in special) for t in texts]
    pieces = [None if w else PRE_TOKENS.findall(t) for t, w in zip(texts, whole, strict=True)]
    new = list(set().union(*(p for p in pieces if p)).difference(known))
    known.update(zip(new, map(len, library.encode_batch_fast(new, add_special_tokens=False)), strict=True))
    counts = [None if p is None else sum(map(known.__getitem__, p)) for p in pieces]
    for piece in new:
        if len(piece) > PIECE_CHARS:
            del known[piece]
    rest = iter(library.encode_batch_fast([t for t, w in zip(texts, whole, strict=True) if w], add_special_tokens=False))
    return [len(next(rest)) if n is None else n for n in counts]


def split_tokens(path: str, text: str) -> tuple[list[int], np.ndarray]:
    """Borders of the pre-tokens of ``text`` and the number of tokens before each."""
    encoded = tokenizer(path).encode(text, add_special_tokens=False)
    words = np.array(encoded.word_ids)
    heads = np.concatenate(([0], np.flatnonzero(words[1:] != words[:-1]) + 1))
    offsets = encoded.offsets
    return [offsets[i][0] for i in heads.tolist()] + [len(text)], np.append(heads, len(words))


def count_one(path: str, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of one text, read in chunks. Borders of pre-tokens are the ones compared, since merges never cross them."""
    if not text:
        return 0
    return sum(int(before[last] - before[first]) for before, first, last in spliced(text, partial(split_tokens, path), chunk, overlap))


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK,
                 overlap: int = OVERLAP) -> DataFrame:
    """``(id, n_bytes, n_tokens)`` per row, as the library counts the whole text without added special tokens.

    A null or empty text has none. Special strings inside texts are handled as the tokenizer file says.
    Repeated rows and null ids stay; no rows give no rows. Memory is bounded by the row, one chunk and
    the remembered pre-tokens.
    """
    importable(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = byte_level(path)
        for batch in batches:
            counts, short, chars = [0] * batch.num_rows, [], 0

            def flush(short: list, counts: list) -> None:
                for (i, _), n in zip(short, count_short(path, [t for _, t in short], cut), strict=True):
                    counts[i] = n

            for i, value in enumerate(batch.column(2)):
                text = value.as_py() or ""
                if len(text) > chunk:
                    counts[i] = count_one(path, text, chunk, overlap)
                    continue
                short.append((i, text))
                chars += len(text)
                if chars >= CHARS_AT_ONCE:
                    flush(short, counts)
                    short, chars = [], 0
            flush(short, counts)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(count, "id long, n_bytes long, n_tokens long")
