"""Connected components of an edge table by alternating large and small stars.

Each round is two aggregations and two joins; the edge table never leaves the
executors. The number of rounds grows with the logarithm of the longest chain.
A node with very many neighbours is pre-aggregated before its shuffle, and the
join back to its edges is an equi join of two exchanges that AQE may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workgrid.llm.common import stored

MAX_ROUNDS = 60


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node that has an edge; ``root`` is the smallest node reachable.

    ``edges`` has columns ``a`` and ``b`` (same type). Loops, repeated edges
    and rows with a null end add nothing. Nodes that are roots are listed with
    themselves. An empty table gives an empty result.
    """
    e = stored(
        spark,
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    seen = None
    for _ in range(MAX_ROUNDS):
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen or state[0] == 0:
            break
        seen = tuple(state)
        e = stored(spark, _small_star(_large_star(e)), "edges")
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (
        both.join(low, "a")
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .where(F.col("a") != F.col("b"))
        .distinct()
    )


def _small_star(e: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the smallest of them."""
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = e.join(low, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()
