"""Connected components of links between ids, as joins that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm import common


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the least id reachable, for every node of ``edges`` (``a``, ``b``).

    Each round takes the least label among a node and its neighbours, then the label of
    that label, so long chains shorten by half. Minima are taken before rows are shuffled,
    so a node of very many links does not meet them in one task.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = common.written(both.where("a <> b").distinct(), "links")
    labels = common.written(
        links.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("component")), "labels"
    )
    while True:
        near = (
            links.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("new")
        )
        jump = labels.select(F.col("node").alias("new"), F.col("component").alias("beyond"))
        moved = common.written(
            lower.join(jump, "new").select("node", "old", F.least("new", "beyond").alias("component")), "labels"
        )
        labels = moved.select("node", "component")
        if moved.where(F.col("old") != F.col("component")).isEmpty():
            return labels
