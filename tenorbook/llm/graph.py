"""Connected components by least labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenorbook.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of (a, b) edges; the label is the least node of its component.

    Each round takes the least label among a node's neighbours and then that label's own label, so chains halve. Rounds are
    stored; joins meet the stored tables directly, so adaptive execution can split a node with many edges.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct())
    labels = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).select(F.col("a").alias("node"), "label"))
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        lower = stored(labels.join(near, F.col("node") == F.col("a")).select("node", F.least("label", "near").alias("label"), F.col("label").alias("old")))
        roots = lower.select(F.col("node").alias("root"), F.col("label").alias("beyond"))
        jumped = stored(lower.join(roots, F.col("label") == F.col("root")).select("node", F.least("label", "beyond").alias("label"), "old"))
        if jumped.filter("label <> old").isEmpty():
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")
