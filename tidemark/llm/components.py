"""Connected components of an edge table, with joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b); the label is the smallest node of the component.

    Every round takes the smallest label among the neighbours, then the label of that label, so that long chains shrink
    by doubling steps. Each round is written to the shared folder; nodes of any degree are handled by aggregates.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct()
    both = written(both, "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels")
    while True:
        of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("other"))
        least = both.join(of_b, "b").groupBy(F.col("a").alias("node")).agg(F.min("other").alias("least"))
        hooked = labels.join(least, "node").select("node", "label", F.least("label", "least").alias("next"))
        # The old label's node passes on what this node has learnt, and then everyone asks its label.
        told = hooked.groupBy(F.col("label").alias("node")).agg(F.min("next").alias("told"))
        hooked = hooked.join(told, "node", "left").select("node", "label", F.least("next", "told").alias("next"))
        up = hooked.select(F.col("node").alias("next"), F.col("next").alias("up"))
        moved = hooked.join(up, "next").select("node", F.col("up").alias("label"), (F.col("up") != F.col("label")).alias("moved"))
        moved = written(moved, "labels")
        labels = moved.select("node", "label")
        if not moved.filter("moved").limit(1).count():
            return labels
