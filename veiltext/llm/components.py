"""Connected components as joins and aggregates over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veiltext.llm.common import Work


def components(edges: DataFrame, work: Work) -> DataFrame:
    """node, label: of every node that has an edge the smallest node of its component.

    edges: columns a, b of any one ordered type; null ends, loops and repeats do no harm. Each round takes the
    smallest label of the neighbours and then the label of the label, so that chains are halved; each round is a
    written table, and only the number of changed labels comes to the driver. No edges: no rows.
    """
    edges = edges.where("a is not null and b is not null and a <> b")
    both = work.save(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct())
    labels = work.save(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        seen = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        new = work.save(seen.join(jump, "next").select("node", "was", F.least("next", "far").alias("label")))
        changed = new.where("was <> label").limit(1).count()
        work.drop(labels)
        labels = new.select("node", "label")
        if not changed:
            work.drop(both)
            return labels
