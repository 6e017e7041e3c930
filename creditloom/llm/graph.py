"""Connected components as joins: least labels, with jumps to the label's own label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.tables import stored


def components(edges: DataFrame) -> DataFrame:
    """node and component, the least node reachable, for all nodes of edges (a, b).

    A round takes the least label among a node and its neighbours, then that label's own
    label, so chains shorten by powers of two. Every round is written to the shared
    folder; it ends when no label changes.
    """
    pairs = stored(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct(), "edges"
    )
    labels = pairs.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("component"))
    labels, left = stored(labels, "labels"), True
    while left:
        heard = (
            pairs.join(labels.select(F.col("node").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        )
        lower = labels.join(heard, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("beyond"))
        rounds = lower.join(jump, "component", "left").select(
            "node", "old", F.least("component", F.coalesce("beyond", "component")).alias("component")
        )
        rounds = stored(rounds, "labels")
        left = bool(rounds.filter("old <> component").limit(1).count())
        labels = rounds.select("node", "component")
    return labels
