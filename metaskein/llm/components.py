"""Connected components of an edge list by repeated min-label hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import stored


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Edges may repeat, run either way, or be loops; no edges give no rows. Each round moves the smallest label of a
    node's neighbours to the node and to its old label, then replaces every label by that label's own. Labels of a path
    halve its length with each round. A hub's edges are combined in each task before the shuffle. Rounds hand over written tables.
    """
    both = stored(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
                    .select("node", F.least("node", "b").alias("label")))
    while True:
        far = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("low")), "b").groupBy("a").agg(F.min("low").alias("low"))
        near = labels.join(far, labels.node == far.a).where("low < label")
        hooks = near.select("node", "low").union(near.select(F.col("label").alias("node"), "low")).groupBy("node").agg(F.min("low").alias("low"))
        hooked = labels.join(hooks, "node", "left").select("node", F.least("label", "low").alias("label"), F.col("low").isNotNull().alias("moved"))
        hooked = stored(hooked)
        if hooked.where("moved").isEmpty():
            return hooked.select("node", F.col("label").alias("component"))
        jump = hooked.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = stored(hooked.join(jump, "label", "left").select("node", F.coalesce("next", "label").alias("label")))
