"""Connected components of an edge table, by label propagation with shortcuts; nothing is brought to the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """node and component (the least node reachable) for every node of the edges (a, b).

    Each round gives a node the least label of its neighbours, then follows labels once more. Labels are aggregated
    with partial sums, so a node with very many edges is no hot task. Every round is kept in files: a checkpoint's rows would
    bear the estimated size of the joins behind them, a number whose digits multiply with each round until planning it fills the driver.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")
    both = cut_lineage(both.distinct())
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "a"), "a").groupBy(F.col("b").alias("node")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("next"))
        target = labels.select(F.col("node").alias("next"), F.col("component").alias("jump"))
        moved = cut_lineage(lower.join(target, "next", "left").select("node", "old", F.least("next", "jump").alias("component")))
        labels = moved.select("node", "component")
        if moved.where("component <> old").agg(F.count("*")).first()[0] == 0:
            return labels
