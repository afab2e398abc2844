"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensormart.session import materialise


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); component is its smallest node.

    Each round takes the smallest label among a node and its neighbours, then the
    label of that label, so that long chains shorten by half. Rounds are written
    to the shared scratch folder. Nulls and repeated links add nothing. A hub is
    no hot spot: labels are aggregated on the map side, and joins with the written
    tables can be split.
    """
    both = links.filter("a <> b").select("a", "b").unionByName(links.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialise(both.distinct(), "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    labels = materialise(labels.withColumn("label", F.least("node", "label")), "labels")
    while True:
        known = labels.select(F.col("node").alias("b"), "label")
        nearest = both.join(known, "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        nearest = materialise(nearest, "nearest")
        lowered = labels.join(nearest, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        lowered = materialise(lowered, "lowered")
        further = lowered.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        jumped = lowered.join(further, "label", "left").select(
            "node", F.least("label", F.coalesce("beyond", "label")).alias("label"), "was"
        )
        jumped = materialise(jumped, "labels")
        if jumped.filter("label <> was").isEmpty():
            return jumped.select("node", F.col("label").alias("component"))
        labels = jumped.drop("was")
