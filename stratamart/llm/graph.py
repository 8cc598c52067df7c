"""Connected components of an edge table, by joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for all nodes of ``edges (a, b)``: the smallest node reachable.

    Each round takes the smallest label among the neighbours and then the label of that label,
    so labels travel twice as far every round. Labels are written to the shared folder between
    rounds; the driver sees one count a round. Minima are formed before each shuffle, so a node
    with very many neighbours costs one row per task.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.where("a <> b").distinct(), "edges")
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("component")),
        "labels",
    )
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("near"))
        lower = labels.join(near, labels.node == near.a).select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("lower")
        )
        target = labels.select(F.col("node").alias("lower"), F.col("component").alias("lowest"))
        moved = stored(
            lower.join(target, "lower").select("node", "before", F.least("lower", "lowest").alias("component")), "labels"
        )
        labels = moved.select("node", "component")
        if moved.where("before <> component").isEmpty():
            return labels
