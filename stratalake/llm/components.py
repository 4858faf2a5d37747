"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratalake.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return (
        both.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    return (
        edges.join(least, "a")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .where("a <> b")
        .unionByName(least.select("a", F.col("least").alias("b")))
        .distinct()
    )


def _digest(edges: DataFrame):
    return edges.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b); a component is named after
    its smallest node.

    Alternating large and small stars: each round is two joins with partial aggregates and halves
    the depth, so the number of rounds grows with the logarithm of the longest chain. Every round
    is a table in the shared folder. Links with a null, and of a node with itself, tie nothing.
    """
    edges = staged(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct(),
        "links",
    )
    seen = _digest(edges)
    while True:
        edges = staged(_small_star(_large_star(edges)), "stars")
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
