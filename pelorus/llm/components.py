"""Connected components by alternating large-star and small-star rounds, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node of the neighbourhood."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of ``edges (a, b)``; the component is the smallest node reached.

    Rounds run until nothing moves, a logarithmic number of them; each is written, so a lost executor costs one round.
    """
    current = durable(edges.filter("a <> b").select("a", "b").distinct())
    state = None
    while True:
        sign = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(sign) == state or not sign[0]:
            break
        state = tuple(sign)
        current = durable(_small_star(_large_star(current)))
    # Stars around the smallest node.
    leaves = current.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return leaves.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
