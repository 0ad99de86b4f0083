"""Connected components by minimum labels with pointer jumping, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkplate.llm.common import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b); ``comp`` is its component's least node.

    Each round takes the least label among the neighbours, then the label of that label,
    and is written to the shared folder; it ends when no label changes.
    """
    both = materialise(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
                         .select("node", F.least("node", "b").alias("comp"), F.lit(True).alias("moved")), "labels")
    while labels.where("moved").limit(1).count():
        near = (both.join(labels.select(F.col("node").alias("b"), "comp"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near")))
        step = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("comp").alias("beyond"))
        labels = materialise(step.join(jump, "next").select(
            "node", F.least("next", "beyond").alias("comp"), (F.least("next", "beyond") < F.col("comp")).alias("moved")), "labels")
    return labels.select("node", "comp")
