"""Connected components over edge tables, in Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from layercake.llm.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is the smallest node that can be reached.

    Every node repeatedly takes the smallest label around it, and then the label of its label, so that
    long chains take few rounds. A round reduces before it shuffles; a node of many edges is one row
    after that. Only counts reach the driver.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = scratch.put(both.filter("a <> b").distinct(), "edges")
    labels = scratch.put(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        least = labels.join(near, "node").select("node", F.least("root", "near").alias("next"), "root")
        jump = least.select(F.col("node").alias("next"), F.col("next").alias("far"))
        moved = least.join(jump, "next", "left").select("node", F.least("next", "far").alias("root"), (F.least("next", "far") < F.col("root")).alias("changed"))
        moved = scratch.put(moved, "labels")
        labels = moved.select("node", "root")
        if moved.filter("changed").isEmpty():
            return labels
