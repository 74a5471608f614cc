"""Connected components by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonearm.llm.common import stash


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the undirected edges (a, b); component is the smallest node.

    Each round takes the smallest label among a node and its neighbours, then that
    label's own label, so labels travel twice as far each time. Rounds are written
    tables; only the number of changed labels reaches the driver.
    """
    both = stash(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    label = stash(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = (
            both.join(label.select(F.col("node").alias("b"), "label"), "b")
            .groupBy("a").agg(F.min("label").alias("near"))
        )
        step = label.join(near, label.node == near.a).select("node", "label", F.least("label", "near").alias("next"))
        jump = label.select(F.col("node").alias("via"), F.col("label").alias("beyond"))
        step = step.join(jump, step.next == jump.via, "left").select(
            "node", F.least("next", "beyond").alias("label"), (F.least("next", "beyond") != F.col("label")).alias("moved")
        )
        step = stash(step, "labels")
        label = step.select("node", "label")
        if not step.where("moved").limit(1).count():
            return label.select("node", F.col("label").alias("component"))
