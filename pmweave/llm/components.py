"""Connected components of links by alternating star contraction.

Every round hangs each node's larger neighbours on the least one (large star), then each node's
smaller ones (small star). Links never grow in number, rounds stay near the logarithm of the
longest path, and a node with a third of all links only ever contributes a grouped minimum and
one join that adaptive execution can split. Each round is written to the shared folder, so a
lost executor costs tasks of one round, and only a count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pmweave.session import discard, stage

MAX_ROUNDS = 100


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` of every node that reaches a lesser one; ``root`` is the least. Other nodes are their own roots.

    Links may repeat, run either way or lead to their own start. Null ends are no links.
    """
    edges = stage(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root")).distinct(), "links")
    seen = _checksum(edges)
    for _ in range(MAX_ROUNDS):
        following = stage(_small_star(_large_star(edges)), "links")
        now = _checksum(following)
        discard(edges)
        edges = following
        if now == seen:
            return edges
        seen = now
    raise RuntimeError(f"links did not settle in {MAX_ROUNDS} rounds")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("root", "node")).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    return (both.where("other > node").join(least, "node")
            .select(F.col("other").alias("node"), F.col("least").alias("root")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("node").agg(F.min("root").alias("least"))
    rehung = edges.join(least, "node").where("root <> least").select(F.col("root").alias("node"), F.col("least").alias("root"))
    return rehung.union(least.toDF("node", "root")).distinct()


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "root"))).first())
