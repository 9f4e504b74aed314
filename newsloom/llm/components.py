"""Connected components of an edge list, by smallest labels with pointer jumping.

Each round every node takes the smallest label among its own and its neighbours', and then the label
of its label. Only sums over keys are shuffled, never a node's neighbours as one value, and each round is a
written table, so lost executors cost no more than a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (columns a, b); label: the smallest node it reaches."""
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")), "labels")
    while True:
        seen = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("n")).agg(F.min("label").alias("near"))
        closer = labels.join(seen, F.col("node") == F.col("n")).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        target = labels.select(F.col("node").alias("t"), F.col("label").alias("further"))
        jumped = closer.join(target, F.col("label") == F.col("t"), "left")
        moved = stored(jumped.select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.where("old <> label").isEmpty():
            return labels
