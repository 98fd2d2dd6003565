"""Connected components of an undirected graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed.session import cut_lineage, release


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, label): the smallest node id of each component.

    The first labels are the smallest neighbours. Every round passes the
    smallest label to the neighbours and to the node that the old label names,
    then follows each label once. Distances to the root shrink by a factor per
    round, so rounds grow with the logarithm of the diameter; labels only ever
    fall, so the loop ends. Minimum aggregates combine in the map tasks, which
    keeps nodes with very many edges cheap.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = cut_lineage(both.where("a <> b").distinct())
    nearest = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("near"))
    held = cut_lineage(nodes.select("id").join(nearest, "id", "left").select(
        "id", F.least("id", F.coalesce("near", "id")).alias("label")))
    while True:
        labels = held.select("id", "label")
        offered = (
            both.join(labels.withColumnRenamed("id", "a"), "a")
            .groupBy(F.col("b").alias("id")).agg(F.min("label").alias("offer"))
            .join(labels, "id").where(F.col("offer") < F.col("label"))
        )
        offers = (
            offered.select(F.explode(F.array("id", "label")).alias("id"), "offer")
            .groupBy("id").agg(F.min("offer").alias("offer"))
        )
        lowered = labels.join(offers, "id", "left").select(
            "id", F.col("label").alias("old"), F.least("label", "offer").alias("label")
        )
        parents = lowered.select(F.col("id").alias("label"), F.col("label").alias("root"))
        after = cut_lineage(lowered.join(parents, "label").select("id", "old", F.col("root").alias("label")))
        release(held)
        held = after
        if after.where("label <> old").isEmpty():
            release(both)
            return after.select("id", "label")
