"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastewell.session import written

ROUNDS = 100


def _least(edges: DataFrame, node: str, other: str) -> DataFrame:
    """Smallest neighbour of each node; partial minima make a hot node cheap."""
    return edges.groupBy(F.col(node).alias("node")).agg(F.min(other).alias("least"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); component is the smallest node reachable.

    Node ids are longs. Loops are ignored, repeated edges count once. Every round is written to the shared
    folder, so lost executors cost one round; nothing but two numbers a round reaches the driver.
    """
    pairs = written(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    state = None
    for _ in range(ROUNDS):
        # Large star: every larger neighbour of a node is linked to the node's smallest neighbour.
        both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least(both, "a", "b").select("node", F.least("node", "least").alias("least"))
        large = (
            both.filter("b > a").join(least, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        )
        large = written(large.filter("a <> b"), "large-star")
        # Small star: a node's smaller neighbours, and the node, are linked to the smallest of them.
        least = _least(large, "a", "b")
        small = (
            large.join(least, F.col("a") == F.col("node"))
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        pairs = written(small, "small-star")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == tuple(now):
            break
        state = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    # Every node is now linked to the smallest of its component alone.
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(pairs.select("b", "b").distinct())
