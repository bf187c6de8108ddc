"""Connected components of an edge table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm.common import checkpoint


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``edges(a, b)``; the label is the smallest node of its component.

    Each round gives a node the smallest label among its neighbours and itself, then lets
    every label follow its own label, so the number of rounds grows with the logarithm of a
    component's diameter rather than with the diameter. A hub's edges are summed in the map tasks; in the joins, both sides are read from
    files and dealt anew, so that a hub's rows are split by AQE.
    """
    links = checkpoint(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .where("a <> b").distinct())
    labels = checkpoint(links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                        .select("node", F.least("node", "low").alias("label")))
    while True:
        # The smallest label around each node and around each label's own node.
        around = links.join(labels, F.col("b") == F.col("node")).select(F.col("a").alias("node"), "label")
        lower = labels.select("node", "label").union(around).groupBy("node").agg(F.min("label").alias("label"))
        hooks = checkpoint(labels.withColumnRenamed("label", "old").join(lower, "node"))
        # A component's representative takes the smallest label any member has met; then all members follow it.
        roots = hooks.groupBy("old").agg(F.min("label").alias("root"))
        follow = checkpoint(hooks.join(roots, "old").select("node", F.least("label", "root").alias("label"),
                                                            (F.least("label", "root") < F.col("old")).alias("moved")))
        jumped = follow.join(follow.select(F.col("node").alias("at"), F.col("label").alias("next")), F.col("label") == F.col("at"), "left")
        jumped = checkpoint(jumped.select("node", F.least("label", F.coalesce("next", "label")).alias("label"), "moved"))
        labels = jumped.select("node", "label")
        if not jumped.where("moved").limit(1).count():
            return labels
