"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.session import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbours and itself."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them. Every edge has a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return joined.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(`node`, `root`) for each node that has a link: root is the smallest node it reaches.

    The edges are written to the shared folder after every round, so a lost executor costs one round at most. Null
    ends and links of a node to itself are no links. Rounds grow with the logarithm of the longest path.
    """
    first, second = F.col(a), F.col(b)
    ordered = edges.where(first.isNotNull() & second.isNotNull() & (first != second)).select(
        F.greatest(first, second).alias("a"), F.least(first, second).alias("b"))
    state = stored(ordered.distinct(), "edges")
    mark = None
    while True:
        found = state.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if found[0] == 0 or found == mark:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root")).union(state.select("b", "b").distinct())
        mark = found
        state = stored(_small_star(_large_star(state)).distinct(), "edges")
