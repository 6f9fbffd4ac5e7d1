"""Groups of linked nodes: connected components by spreading the smallest id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every end of the edges (a, b); root is the smallest node of its component.

    Each round gives a node the smallest root among its neighbours and itself, then lets it jump to its root's root.
    Labels are written to the shared folder after each round; rounds end when no label changes.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stored(both, "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                    .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near")))
        low = labels.join(near, "node").select("node", F.least("root", "near").alias("new"), "root")
        up = labels.select(F.col("node").alias("new"), F.col("root").alias("upper"))
        after = stored(low.join(up, "new", "left")
                          .select("node", F.coalesce(F.least("new", "upper"), F.col("new")).alias("next"), "root"), "labels")
        changed = after.where(F.col("next") != F.col("root")).limit(1).count()
        labels = after.select("node", F.col("next").alias("root"))
        if not changed:
            return labels
