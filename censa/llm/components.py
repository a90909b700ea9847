"""Connected components by label propagation with pointer jumping, for any node type that has an order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censa.llm.shared import kept


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node of the edges (a, b).

    Each round takes the smallest label around a node, then the label of that label, so in
    practice few rounds do even for long chains.  Nothing but the number of
    changes comes to the driver.  A null end or an edge from a node to itself is left out.
    """
    pairs = edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    both = kept(pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "component-edges")
    labels = kept(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "component-labels")
    while True:
        around = both.join(labels, both.a == labels.node).groupBy(F.col("b").alias("node")).agg(F.min("component").alias("near"))
        lower = labels.join(around, "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("component"))
        # The label of the label, as it was before this round.
        roots = labels.select(F.col("node").alias("root"), F.col("component").alias("far"))
        moved = lower.join(roots, lower.component == roots.root, "left").select("node", F.least("component", F.coalesce("far", "component")).alias("component"), "was")
        moved = kept(moved, "component-labels")
        labels = moved.select("node", "component")
        if moved.filter("component <> was").isEmpty():
            return labels
