"""Rows that share a key brought together, with no task holding an unbounded group.

Buckets of up to ``limit`` rows are one group. Larger ones are cut into parts by a hash, and every
two parts form a group of their own, so all pairs of rows of a bucket meet, in groups of at most
about twice ``limit`` rows, on as many tasks as there are pairs of parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pmweave.session import stage

LIMIT = 2048


def meet(entries: DataFrame, keys: list[str], member: str, limit: int = LIMIT) -> DataFrame:
    """``entries`` with ``low``, ``high`` and ``part``, dealt out and sorted by group.

    A pair belongs to the group (low, high) of its two parts; where these differ, only rows of
    different parts are to be compared. Only oversized buckets are looked up, so the rows stay as many
    as the entries; their list is staged, and Spark broadcasts it if its size allows.
    """
    large = stage(entries.groupBy(*keys).agg(F.count("*").alias("met")).where(F.col("met") > limit), "large")
    parts = F.ceil(F.coalesce("met", F.lit(1)) / limit).cast("int")
    placed = entries.join(large, keys, "left").withColumn("part", F.pmod(F.xxhash64(member), parts).cast("int"))
    other = F.explode(F.sequence(F.lit(0), parts - 1))
    grouped = placed.withColumn("other", other).select(
        *entries.columns, F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part")
    group = [*keys, "low", "high"]
    return grouped.repartition(*group).sortWithinPartitions(*group)


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold whole groups, with the row where each begins (and the end); ``keys`` leading integer columns name a group."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        starts = _starts(table, keys)
        if len(starts) > 1:  # the last group may go on in the next batch
            yield table.slice(0, starts[-1]), starts
            table = table.slice(starts[-1])
        held = table
    if held is not None and held.num_rows:
        yield held, np.append(_starts(held, keys), held.num_rows)


def _starts(table: pa.Table, keys: int) -> np.ndarray:
    if not table.num_rows:
        return np.zeros(0, np.int64)
    changes = np.zeros(table.num_rows, bool)
    changes[0] = True
    for column in table.columns[:keys]:
        values = column.to_numpy()
        changes[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(changes)


def forest(n: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links ``left[i] - right[i]`` between ``n`` rows, as few as keep the same rows connected.

    Earlier links are preferred, so links in order of distance leave a least spanning forest, in
    which each row keeps a link to its nearest. Rows are joined round by round, each group of them by its first link out.
    """
    group, keep, open_ = np.arange(n), [], np.arange(len(left))
    while True:
        a, b = group[left[open_]], group[right[open_]]
        apart = a != b
        open_, a, b = open_[apart], a[apart], b[apart]
        if not len(open_):
            break
        first = np.full(n, len(left))
        np.minimum.at(first, a, open_)
        np.minimum.at(first, b, open_)
        chosen = np.unique(first[first < len(left)])
        keep.append(chosen)
        parent = list(range(n))
        for x, y in zip(group[left[chosen]].tolist(), group[right[chosen]].tolist(), strict=True):
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            while parent[y] != y:
                parent[y] = y = parent[parent[y]]
            parent[max(x, y)] = min(x, y)
        for x in range(n):  # parents come before their children
            parent[x] = parent[parent[x]]
        group = np.array(parent)[group]
    kept = np.concatenate(keep) if keep else np.zeros(0, np.int64)
    return left[kept], right[kept]
