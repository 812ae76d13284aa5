"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node it can reach.

    Each round takes the smallest label among the neighbours' labels and then the label of that
    label, so distances halve; a label table is stored per round. Labels of a node with many
    neighbours are reduced where they are read.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()
    both = stored(both, "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        seen = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("n")).agg(F.min("label").alias("near"))
        lower = labels.join(seen, F.col("node") == F.col("n"), "left").select("node", "label", F.least("label", F.coalesce("near", "label")).alias("to"))
        far = labels.select(F.col("node").alias("at"), F.col("label").alias("jump"))
        moved = lower.join(far, F.col("to") == F.col("at"), "left").select("node", F.col("label").alias("old"), F.least("to", F.coalesce("jump", "to")).alias("label"))
        moved = stored(moved, "labels")
        if moved.filter("old <> label").isEmpty():
            return moved.select("node", F.col("label").alias("component"))
        labels = moved.select("node", "label")
