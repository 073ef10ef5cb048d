"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.session import checkpoint

MAX_ROUNDS = 100


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the component is named after its smallest node.

    Alternates large-star and small-star steps (Kiveris et al., 2014): every node points its larger, then
    its smaller neighbours at the smallest one it knows. A step is a min-aggregate, combined before the
    shuffle, and an equi-join, so a node with very many neighbours is never gathered in one task. The edge
    table is checkpointed each round; rounds grow with the logarithm of the number of nodes.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    current = checkpoint(_descending(pairs))
    signature = None
    for _ in range(MAX_ROUNDS):
        current = checkpoint(_small_star(_large_star(current)))
        seen = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
        ).first()
        if tuple(seen) == signature:
            roots = current.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
            return nodes.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
        signature = tuple(seen)
    raise RuntimeError("connected components did not settle")


def _descending(pairs: DataFrame) -> DataFrame:
    """Each edge once, from the larger to the smaller node."""
    return (
        pairs.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node to the smallest node among it and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = both.where(F.col("v") > F.col("u")).join(smallest, "u")
    return _descending(larger.select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect a node and its smaller neighbours to the smallest of them."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(smallest, "u")
    return _descending(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(smallest.select("u", "m")))
