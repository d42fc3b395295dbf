"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareledger.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.join(least, "a").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return (linked.unionByName(least.select("a", F.col("m").alias("b")))
            .where(F.col("a") != F.col("b")).distinct())


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root) of every node with an edge in ``edges`` (a, b); the root is its least node.

    A round pulls every node's neighbours to its least neighbour; the number of rounds grows with
    the logarithm of the longest chain. Only edges are shuffled, minima are combined before the
    shuffle, and no node's neighbours are gathered, so a hub is no bottleneck.
    """
    edges = stored(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct())
    state = _state(edges)
    for _ in range(rounds):
        if state[0] == 0:
            break
        edges = stored(_small_star(_large_star(edges)))
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
