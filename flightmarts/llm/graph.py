"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node with an edge; component is its smallest id.

    ``edges``: columns a, b (long). Each round points every node at its smallest
    neighbour (a partial aggregate, so a hub costs one row per task), follows the
    pointers to the local minima, and contracts the edges to those. The nodes that
    remain at least halve, so rounds grow with the logarithm of the nodes. Each
    step is a written table; nothing but row counts reaches the driver.
    """
    ends = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b")
    edges = materialize(ends.distinct(), "cc-edges")
    labels = None
    while not edges.isEmpty():
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = materialize(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("to")), "cc-to")
        while True:  # follow the pointers
            up = to.select(F.col("id").alias("to"), F.col("to").alias("up"))
            jumped = materialize(to.select("id", "to").join(up, "to").select("id", F.col("up").alias("to"), (F.col("up") != F.col("to")).alias("moved")), "cc-jump")
            to = jumped
            if jumped.where("moved").isEmpty():
                break
        step = to.select("id", "to")
        if labels is None:
            labels = step
        else:
            nxt = step.select(F.col("id").alias("to"), F.col("to").alias("up"))
            labels = materialize(labels.join(nxt, "to", "left").select("id", F.coalesce("up", "to").alias("to")), "cc-labels")
        left = edges.join(step.select(F.col("id").alias("a"), F.col("to").alias("x")), "a")
        both_ends = left.join(step.select(F.col("id").alias("b"), F.col("to").alias("y")), "b")
        edges = materialize(
            both_ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a < b").distinct(), "cc-edges"
        )
    if labels is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return labels.select("id", F.col("to").alias("component"))
