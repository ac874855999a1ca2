"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlog.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them. Links point from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(least, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(least.select("a", F.col("low").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest node it can reach.

    The two star operations alternate until nothing changes; each keeps the
    number of links and halves long chains, so the rounds grow with the
    logarithm of the longest path. Every round is written to the shared folder.
    """
    edges = materialize(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links",
    )

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    now = state(edges)
    while now[0]:
        edges = materialize(_small_star(_large_star(edges)), "links")
        before, now = now, state(edges)
        if before == now:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root"))
    ).distinct()
