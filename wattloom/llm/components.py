"""Connected components of an edge table, by labels that fall to the smallest node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.storage import Scratch


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(node, component) of (a, b): every node with its smallest reachable node.

    Each round takes the smallest label next to a node and then that label's own label, so distances halve. Rounds go
    on until no label changes; only their number and one count come to the driver. Labels are written each round, and only
    the last ones kept, in ``scratch`` where the caller deletes them with the rest.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    both = scratch.stored(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = scratch.stored(both.groupBy("a").agg(F.min("b").alias("_near")).select(F.col("a").alias("node"), F.least("a", "_near").alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("component").alias("_near"))
        lower = near.join(labels, near["a"] == labels["node"]).select("node", F.col("component").alias("_old"), F.least("component", "_near").alias("_low"))
        jump = labels.select(F.col("node").alias("_low"), F.col("component").alias("_far"))
        moved = scratch.stored(lower.join(jump, "_low").select("node", F.least("_low", "_far").alias("component"), "_old"), "labels")
        scratch.drop("labels", keep=1)
        labels = moved.select("node", "component")
        if moved.where(F.col("component") != F.col("_old")).isEmpty():
            scratch.drop("edges")
            return labels
