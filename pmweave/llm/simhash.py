"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into segments. Two fingerprints within the distance agree closely in at least
one of them, so each is entered into a table per segment under its own segment value or under all
values of a small Hamming ball around it, rows under the same value are fetched together, and the
distance of the complete fingerprints decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pmweave.llm.components import connected
from pmweave.llm.fingerprints import SHINGLE_WORDS, WIDE, add_fingerprints, add_wide_fingerprints, set_name, shingle_set, simhash
from pmweave.llm.meetings import LIMIT, forest, groups, meet
from pmweave.llm.workers import importable
from pmweave.session import stage

BITS = 64
THIRD_DISTANCE = 8
WIDE_DISTANCE = 52  # of 192 bits: sets with a cosine of 0.8 differ in 39.3 +- 5.6, with a Jaccard similarity of 0.8 in 29.1 +- 5.0
LIMIT_OF_SETS = 512  # rows of a part that bring their shingle sets along
SHINGLES_AT_ONCE = 1 << 22  # bounds the memory of one row's comparisons


def probes(distance: int, segments: int) -> list[tuple[int, int, int]]:
    """``(segment, mask of its bits, bits to flip)`` of every entry of a fingerprint.

    Both sides of a pair are entered, so balls of radius 1 meet up to a distance of 2 within the
    segment, and plain values meet at 0. With ``balls`` segments of the first kind a pair that meets
    nowhere differs in at least ``3 * balls + (segments - balls)`` bits, which must exceed the distance.
    """
    balls = max(0, -((segments - distance - 1) // 2))
    if balls > segments:
        raise ValueError(f"{segments} segments are too few for a distance of {distance}")
    cuts = [BITS * s // segments for s in range(segments + 1)]
    entries = []
    for s, (start, end) in enumerate(zip(cuts, cuts[1:], strict=False)):
        mask = ((1 << end) - 1) ^ ((1 << start) - 1)
        entries += [(s, mask, flip) for flip in [0] + [1 << bit for bit in range(start, end) if s < balls]]
    return entries


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def hamming_links(prints: DataFrame, distance: int, segments: int = 3, limit: int = LIMIT, wide: bool = False) -> DataFrame:
    """Links ``(a, b)`` that connect exactly the distinct fingerprints ``fp`` within ``distance`` bits.

    Within each group only as many links are returned as keep the same rows connected, the nearest
    first, so the result stays linear in the entries even where thousands are all near each other.

    With ``wide`` a fingerprint is the 192 bits of the columns ``WIDE``, rows are named by ``class``, and each
    third is entered for ``THIRD_DISTANCE``. Pairs within ``3 * THIRD_DISTANCE + 2`` bits differ in no more than
    that in one third and surely meet; of those up to ``distance`` the pairs are linked that meet in a segment.
    """
    importable(prints.sparkSession)
    thirds, found = (WIDE, THIRD_DISTANCE) if wide else (["fp"], distance)
    name = "class" if wide else "fp"
    columns = list(dict.fromkeys([name, *thirds]))
    probe = F.explode(F.array(*[
        F.struct(F.lit(t * segments + s).alias("segment"), F.col(third).bitwiseAND(F.lit(_signed(m))).bitwiseXOR(F.lit(_signed(f))).alias("value"))
        for t, third in enumerate(thirds) for s, m, f in probes(found, segments)]))
    entries = prints.select(*columns, probe.alias("p")).select("p.segment", "p.value", *columns)
    met = meet(entries, ["segment", "value"], name, limit)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in groups(batches, 4):
            words = [table.column(third).to_numpy().view(np.uint64) for third in thirds]
            group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            left, apart = [], []
            for step in range(1, int(np.diff(starts).max())):
                bits = sum(np.bitwise_count(w[:-step] ^ w[step:]) for w in words)
                left.append(np.flatnonzero((bits <= distance) & (group[:-step] == group[step:])).astype(np.int32))
                apart.append(bits[left[-1]])
            if not left:
                continue
            right = np.concatenate([at + np.int32(step) for step, at in enumerate(left, start=1)])
            nearest = np.argsort(np.concatenate(apart), kind="stable")
            a, b = forest(len(group), np.concatenate(left)[nearest], right[nearest])
            if len(a):
                names = table.column(name).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(names[a]), pa.array(names[b])], names=["a", "b"])

    return met.select("segment", "value", "low", "high", *columns).mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 4,
                    words: int = SHINGLE_WORDS, segments: int = 3, limit: int = LIMIT) -> DataFrame:
    """``(id, fp, component)`` per row: the fingerprint as a signed long, the least id reachable by links.

    Null and wordless texts have the fingerprint zero and link like any other. Rows of equal
    fingerprints are one class and are never paired with each other; repeated ids keep their rows.
    A null id keeps its row and takes part in links; the component is null only where no row of it
    has an id. An empty table gives an empty result. Other columns of ``docs`` are not looked at.
    """
    importable(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    prints = stage(rows.mapInArrow(lambda batches: add_fingerprints(batches, words), "id long, fp long"), "fingerprints")
    classes = stage(prints.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    roots = connected(hamming_links(classes, distance, segments, limit), "a", "b")
    return _components(prints, classes, roots).select("id", "fp", "component")


def fingerprint_text(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def verified(sets: list[np.ndarray], prints: list[np.ndarray], parts: np.ndarray | None, distance: int, similarity: float,
             cosine: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs within ``distance`` bits whose ``sets`` have a Jaccard similarity of at least ``similarity``.

    With ``cosine`` it is shared shingles over the geometric mean of both sizes instead.
    Every such pair is counted exactly, unless its rows are joined by counted pairs already. With
    ``parts`` only rows of different parts are pairs.
    """
    sizes = np.array([len(x) for x in sets])
    numbers = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.concatenate(([0], np.cumsum(sizes)))
    held = [numbers[a:b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
    mine, root, links = np.zeros(len(numbers), bool), np.arange(len(sets)), []
    for i in range(len(sets) - 1):
        rest = slice(i + 1, None)
        bits = sum(np.bitwise_count(w[i] ^ w[rest]) for w in prints)
        fits = np.minimum(sizes[i], sizes[rest]) >= (similarity ** 2 - 1e-9 if cosine else similarity) * np.maximum(sizes[i], sizes[rest])
        near = (bits <= distance) & (root[rest] != root[i]) & fits & (sizes[rest] > 0)
        if parts is not None:
            near &= parts[rest] != parts[i]
        near = i + 1 + np.flatnonzero(near)
        if not len(near):
            continue
        mine[held[i]] = True
        for some in np.array_split(near, 1 + int(sizes[near].sum()) // SHINGLES_AT_ONCE):
            if not len(some):
                continue
            at = np.cumsum(sizes[some]) - sizes[some]
            both = np.add.reduceat(mine[np.concatenate([held[j] for j in some.tolist()])], at, dtype=np.int64)
            alike_ = some[both >= similarity * (np.sqrt(sizes[i] * sizes[some]) if cosine else sizes[i] + sizes[some] - both)]
            roots, first = np.unique(root[alike_], return_index=True)
            links += [(i, j) for r, j in zip(roots.tolist(), alike_[first].tolist(), strict=True) if r != root[i]]
            root[np.isin(root, roots)] = root[i]
        mine[held[i]] = False
    left, right = np.array(links, np.int64).reshape(-1, 2).T
    return left, right


def alike(roots: DataFrame, classes: DataFrame, rows: DataFrame, words: int, similarity: float, distance: int, limit: int = LIMIT,
          cosine: bool = False) -> DataFrame:
    """Links ``(a, b)`` that connect exactly the texts within ``distance`` bits whose distinct shingles are at least ``similarity`` alike (``verified``).

    ``roots`` holds the groups that candidates connect. A pair of candidates never lies across two of them, so
    the shingle sets of a group are brought together once and all its pairs are compared there.
    A ``class`` is the texts of one shingle set; that of its ``least`` row is read.
    """
    grouped = roots.select(F.col("node").alias("class"), "root").union(roots.select("root", "root").distinct())
    wanted = classes.join(grouped, "class").select(F.col("least").alias("id"), "root", "class", *WIDE, "same")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t.as_py(), words) for t in batch.column("text")]
            mine = [i for i, (x, same) in enumerate(zip(found, batch.column("same"), strict=True)) if set_name(x) == same.as_py()]  # a repeated id may have other texts
            kept = batch.select(["root", "class", *WIDE]).take(pa.array(mine, pa.int64()))
            shingles = pa.array([found[i].tobytes() for i in mine], pa.binary())
            yield pa.RecordBatch.from_arrays([*kept.columns, shingles], names=["root", "class", *WIDE, "shingles"])

    def enough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in groups(batches, 3):
            low, high, part, names, *prints = (table.column(c).to_numpy() for c in ("low", "high", "part", "class", *WIDE))
            for at, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                if end - at < 2:
                    continue
                shingles = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("shingles")[at:end]]
                parts = part[at:end] if low[at] != high[at] else None
                a, b = verified(shingles, [w[at:end].view(np.uint64) for w in prints], parts, distance, similarity, cosine)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(names[at + a]), pa.array(names[at + b])], names=["a", "b"])

    held = rows.join(wanted, "id").select("root", "class", *WIDE, "same", "text")
    longs = ", ".join(f"{c} long" for c in ["root", "class", *WIDE])
    held = held.mapInArrow(sets, f"{longs}, shingles binary").dropDuplicates(["class"])
    met = meet(stage(held, "shingles"), ["root"], "class", min(limit, LIMIT_OF_SETS))
    return met.select("root", "low", "high", "part", "class", *WIDE, "shingles").mapInArrow(enough, "a long, b long")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, similarity: float = 0.8,
                distance: int = WIDE_DISTANCE, limit: int = LIMIT, measure: str = "jaccard") -> DataFrame:
    """``(id, component)`` per row with an id: groups of texts that are alike in at least ``similarity`` of their shingles.

    ``measure`` is ``jaccard`` or ``cosine``, the one that fingerprints estimate: shared shingles over the geometric
    mean of both sizes.
    Wide fingerprints find the groups that candidates connect, and in each group the shingle sets of all pairs
    within ``distance`` bits decide; only what has passed is thinned to a spanning forest. Texts of equal
    shingle sets are one class; null and wordless texts are one too. Repeated ids keep their rows, rows without an id
    are left out, an empty table gives an empty result, and other columns are not looked at.
    """
    if measure not in ("jaccard", "cosine"):
        raise ValueError(f"no measure {measure}")
    importable(docs.sparkSession)
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    prints = stage(rows.mapInArrow(lambda batches: add_wide_fingerprints(batches, words), "id long, same binary, " + ", ".join(f"{c} long" for c in WIDE)), "fingerprints")
    classes = prints.groupBy("same").agg(F.min("id").alias("least"), *[F.min(c).alias(c) for c in WIDE])
    classes = stage(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    candidates = connected(hamming_links(classes, distance, limit=limit, wide=True), "a", "b")
    links = alike(candidates, classes, rows, words, similarity, distance, limit, measure == "cosine")
    return _components(prints, classes, connected(links, "a", "b"), "class", "same").select("id", "component")


def _components(prints: DataFrame, classes: DataFrame, roots: DataFrame, name: str = "fp", key: str = "fp") -> DataFrame:
    """``prints`` with the least id of all classes under the same root; ``key`` is their class, which links call ``name``."""
    named = classes.select(F.col(name).alias("node"), F.col(key).alias("key"), "least")
    linked = named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = linked.groupBy("root").agg(F.min("least").alias("component"))
    return prints.join(linked.join(least, "root").select(F.col("key").alias(key), "component"), key)


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with one of each group of near copies: that of the least ``doc_id``.

    Of repeated rows of the kept id one stays; rows without an id stay as they are.
    """
    found = near_copies(docs, **options).where("id = component").select(F.col("id").alias("doc_id")).distinct()
    named = docs.where(F.col("doc_id").isNotNull())
    kept = named.join(found, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))
