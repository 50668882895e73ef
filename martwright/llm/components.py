"""Connected components of a graph that no single task could hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import cut


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has an edge; the component is its smallest node.

    ``edges`` has two columns of one type; direction, loops, repeats and nulls do not matter. A
    distributed union-find: each round hangs all neighbours of a node below the smallest one, first
    the larger neighbours and then the smaller ones, so trees shrink to stars in a number of rounds
    that is logarithmic in practice. Nodes meet in joins and minima that Spark reduces before it
    shuffles; a hub's rows can be split by adaptive execution. Each round ends in a reliable
    checkpoint.
    """
    a, b = edges.columns
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    tree = edges.where((F.col(a) != F.col(b))).select(u, v).distinct()
    tree, seen = cut(tree), None
    for _ in range(max_rounds):
        tree = cut(_smaller(_larger(tree)))
        now = tree.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return tree.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                tree.select("v", "v").distinct()
            )
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _larger(tree: DataFrame) -> DataFrame:
    """Every neighbour above a node now points to the smallest of the node and its neighbours."""
    both = tree.select("u", "v").union(tree.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    pairs = both.join(least, "u").where(F.col("v") > F.col("u"))
    return pairs.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _smaller(tree: DataFrame) -> DataFrame:
    """A node and its neighbours below it now point to the smallest of them."""
    least = tree.groupBy("u").agg(F.min("v").alias("m"))
    below = tree.join(least, "u").where(F.col("v") != F.col("m"))
    moved = below.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
