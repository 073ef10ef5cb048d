"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.llm.frames import stored


def components(edges: DataFrame) -> DataFrame:
    """Columns ``node``, ``label`` for every end of the edges (``a``, ``b``); equal labels: connected.

    Each round points every node to its smallest neighbour (or itself), follows the pointers twice and
    contracts the edges, so that at least all nodes that are no local minimum vanish. Labels are node values.
    A hub costs one row per edge and round, combined before the shuffle.
    """
    edges = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("label", F.col("node"))
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("to"))
        to = stored(to, "pointers")
        for _ in range(2):
            up = to.select(F.col("node").alias("to"), F.col("to").alias("further"))
            to = to.join(up, "to").select("node", F.col("further").alias("to"))
        to = stored(to, "pointers")
        labels = stored(
            labels.join(to.select(F.col("node").alias("label"), "to"), "label", "left").select(
                "node", F.coalesce("to", "label").alias("label")
            ),
            "labels",
        )
        left = edges.join(to.select(F.col("node").alias("a"), F.col("to").alias("u")), "a")
        left = left.join(to.select(F.col("node").alias("b"), F.col("to").alias("v")), "b").where("u <> v")
        edges = stored(left.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct(), "edges")
    return labels
