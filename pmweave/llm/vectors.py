"""Embedding near-duplicates by a pivot-permutation index.

A vector is described by its nearest reference points (pivots), in order. Inverted lists are kept per
set of ``shared`` of a vector's ``nearest`` pivots, so two vectors meet in a list exactly if they share
that many, and in how many lists they meet follows from the count. A pair is verified, in double
precision, only in the first of the lists it shares, so every pair is counted once and nothing is
emitted per pair: a group returns each member's number of links and a spanning forest of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pmweave.llm.components import connected
from pmweave.llm.meetings import LIMIT, forest, groups, meet
from pmweave.llm.workers import importable
from pmweave.session import stage

PIVOTS = 96
SAMPLE = 4096  # vectors that the pivots are chosen from, those of the least hash
APART = 0.7  # no two pivots are more alike than this while others are left
NEAREST = 5
SHARED = 3


def choose_pivots(classes: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray:
    """Reference points from a bounded sample of distinct vectors: in hash order, skipping what is like one chosen already."""
    rows = classes.orderBy(F.xxhash64("vector"), "least").limit(sample).select("vector").collect()  # bounded by ``sample``
    chosen: list[np.ndarray] = []
    skipped: list[np.ndarray] = []
    for (values,) in rows:
        v = np.array(values, np.float64)
        v /= np.linalg.norm(v)
        if len(chosen) == pivots:
            break
        (skipped if chosen and (np.array(chosen) @ v).max() > APART else chosen).append(v)
    return np.array((chosen + skipped)[:pivots])


def near_links(classes: DataFrame, pivots: np.ndarray, cosine: float, nearest: int = NEAREST, shared: int = SHARED, limit: int = LIMIT) -> DataFrame:
    """``(a, b, links_a)`` over classes ``(class, size, vector)``: rows with ``b`` are links of a spanning forest,
    rows without tell how many vectors outside its class ``a`` was found linked to in one group."""
    importable(classes.sparkSession)
    nearest = min(nearest, len(pivots))
    shared = min(shared, nearest)
    wanted = np.array(list(combinations(range(nearest), shared)))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = np.array(batch.column(2).to_pylist(), np.float64)
            vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
            near = np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :nearest]
            sets = np.sort(near, axis=1)[:, wanted]  # ascending, so equal sets are equal numbers
            lists = np.sort(sets @ (len(pivots) ** np.arange(shared)), axis=1)
            data = vectors.tobytes()
            width = vectors.shape[1] * 8
            n = lists.shape[1]
            flat = [data[i * width:(i + 1) * width] for i in range(len(vectors)) for _ in range(n)]
            key = lists.astype("<i8").tobytes()
            keys = [key[i * n * 8:(i + 1) * n * 8] for i in range(len(vectors)) for _ in range(n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(lists.ravel(), pa.int64()), pa.array(np.repeat(batch.column(0).to_numpy(), n)), pa.array(np.repeat(batch.column(1).to_numpy(), n)),
                 pa.array(keys, pa.binary()), pa.array(flat, pa.binary())], names=["list", "class", "size", "lists", "vector"])

    lists = classes.select("class", "size", "vector").mapInArrow(describe, "list long, class long, size long, lists binary, vector binary")
    met = meet(lists, ["list"], "class", limit).select("list", "low", "high", "part", "class", "size", "lists", "vector")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in groups(batches, 3):
            names, sizes = table.column("class").to_numpy(), table.column("size").to_numpy()
            parts, high, key = table.column("part").to_numpy(), table.column("high").to_numpy(), table.column("list").to_numpy()
            vectors = np.frombuffer(b"".join(table.column("vector").to_pylist()), np.float64).reshape(len(names), -1)
            owned = np.frombuffer(b"".join(table.column("lists").to_pylist()), np.int64).reshape(len(names), -1)
            left, right, counts = [], [], np.zeros(len(names), np.int64)
            for at, end in zip(starts[:-1], starts[1:], strict=True):
                if end - at < 2:
                    continue
                near = vectors[at:end] @ vectors[at:end].T >= cosine
                near &= names[at:end, None] != names[None, at:end]
                if table.column("low")[at].as_py() != high[at]:
                    near &= parts[at:end, None] != parts[None, at:end]
                a, b = np.nonzero(np.triu(near, 1))
                if not len(a):
                    continue
                lower = owned[at:end]
                earlier = np.zeros(len(a), bool)  # they share a list before this one: counted there
                for j in range(lower.shape[1]):
                    mine = lower[a, j]
                    earlier |= (mine < key[at]) & (mine[:, None] == lower[b]).any(axis=1)
                a, b = a[~earlier] + at, b[~earlier] + at
                np.add.at(counts, a, sizes[b])
                np.add.at(counts, b, sizes[a])
                keep = forest(end - at, a - at, b - at)
                left.append(keep[0] + at)
                right.append(keep[1] + at)
            some = np.flatnonzero(counts)
            a = np.concatenate([*left, some]).astype(np.int64)
            b = np.concatenate(right).astype(np.int64) if right else np.zeros(0, np.int64)
            if not len(a):
                continue
            other = pa.array(np.append(names[b], np.zeros(len(some), np.int64)), mask=np.arange(len(a)) >= len(b))
            linked = np.append(np.zeros(len(b), np.int64), counts[some])
            yield pa.RecordBatch.from_arrays([pa.array(names[a]), other, pa.array(linked)], names=["a", "b", "links_a"])

    return met.mapInArrow(verify, "a long, b long, links_a long")


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95, pivots: int = PIVOTS, sample: int = SAMPLE,
                    nearest: int = NEAREST, shared: int = SHARED, limit: int = LIMIT) -> DataFrame:
    """``(id, n_links, component, kept)`` per row.

    Links are pairs found with at least ``cosine`` (recall is measured in the tests), none below it.
    Equal vectors are one class, linked with each other. Vectors that are null, zero, or hold null or
    non-finite components link with nothing. Vectors of different lengths have no cosine; each length has an index of its own. A null id keeps its row; its component is null if nothing
    it reaches has an id, and it is never kept. Repeated rows are vectors of their own. No rows give no rows.
    """
    values = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    sound = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(values, lambda x: x != 0)
    # Scaling by a power of two is exact and keeps the squares of huge or tiny values finite.
    top = F.array_max(F.transform(values, F.abs))
    scaled = F.transform(values, lambda x: x / F.pow(F.lit(2.0), F.floor(F.log2(top))))
    read = stage(rows.select(F.col(id_col).cast("long").alias("id"), F.when(sound, scaled).alias("vector")), "vectors")
    classes = read.where("vector is not null").groupBy("vector").agg(F.min("id").alias("least"), F.count("*").alias("size"))
    classes = stage(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    lengths = [r.dims for r in classes.groupBy(F.size("vector").alias("dims")).count().where("count > 1").orderBy("dims").collect()]  # as many as there are lengths
    found = classes.sparkSession.createDataFrame([], "a long, b long, links_a long")
    for dims in lengths:
        mine = classes.where(F.size("vector") == dims)
        found = found.union(near_links(mine, choose_pivots(mine, pivots, sample), cosine, nearest, shared, limit))
    found = stage(found, "near")
    outside = found.where("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("links_a").alias("outside"))
    roots = connected(found.where("b is not null"), "a", "b").withColumnRenamed("node", "class")
    joined = classes.join(outside, "class", "left").join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    least = joined.groupBy("root").agg(F.min("least").alias("component"))
    n_links = (F.col("size") - 1 + F.coalesce("outside", F.lit(0))).alias("n_links")
    known = joined.join(least, "root").select("vector", n_links, "component")
    linked = read.where("vector is not null").join(known, "vector").select("id", "n_links", "component")
    alone = read.where("vector is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    both = linked.union(alone)
    return both.withColumn("kept", F.coalesce(F.col("id") == F.col("component"), F.lit(False)))
