"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.session import parts_of, pin

#: Rows of a partition of labels, at most.
PART_ROWS = 50_000


def components(links: DataFrame) -> DataFrame:
    """(node, label) for each end of ``links`` (a, b): the label is the least node of its component.

    A round takes the least label among the neighbours, then the label of that label, so paths halve; it ends when no label
    changes. Each round is written, so a lost executor costs one round.
    """
    both = pin(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), parts_of(links.sparkSession, 2 * links.count(), PART_ROWS))
    parts = parts_of(links.sparkSession, both.count(), PART_ROWS)
    labels = pin(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), parts)
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node"))
        seen = labels.join(near.agg(F.min("label").alias("near")), "node")
        # A label is itself a node: what its neighbours found moves all nodes that carry it.
        hooks = seen.groupBy("label").agg(F.min("near").alias("hook"))
        moved = labels.join(hooks, "label").select("node", F.col("label").alias("was"), F.least("label", "hook").alias("label"))
        jump = moved.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = pin(moved.join(jump, "label", "left").select("node", "was", F.least("label", "next").alias("label")), parts)
        if after.where("label <> was").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")
