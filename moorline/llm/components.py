"""Connected components by least label, with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorline.llm.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, label)`` for each end of ``edges (a, b)``: the least node of its component.

    Each round takes the least label among the neighbours and then the label of that label,
    so a chain shortens by half and a star ends at once. Labels are written out every round;
    nothing but a count of changed rows comes to the driver.
    """
    both = scratch.save(
        edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct()
    )
    labels = scratch.save(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")))
    while True:
        near = (
            both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        )
        stepped = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("step"))
        heads = labels.select(F.col("node").alias("step"), F.col("label").alias("head"))
        jumped = stepped.join(heads, "step", "left").select(
            "node", F.least("step", "head").alias("label"), (F.least("step", "head") < F.col("label")).alias("moved")
        )
        after = scratch.save(jumped)
        moved = after.where("moved").limit(1).count()
        scratch.drop(labels)
        labels = after
        if not moved:
            scratch.drop(both)
            return labels.select("node", "label")
