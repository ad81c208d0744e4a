"""Connected components of a link table, by smallest label with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    Each round takes the smallest label among a node's neighbours and then
    the label of its label, so that distances halve.  Joins meet one row per
    node or label; the side that may hold a hot node is split by AQE, and
    minima are pre-aggregated before their shuffle.
    """
    edges = cut(links.select(F.col(a).alias("u"), F.col(b).alias("v"))
                .unionByName(links.select(F.col(b).alias("u"), F.col(a).alias("v"))).distinct())
    labels = cut(edges.groupBy(F.col("u").alias("node"))
                 .agg(F.min("v").alias("v"))
                 .select("node", F.least("node", "v").alias("component")))
    while True:
        near = (edges.join(labels.withColumnRenamed("node", "v"), "v")
                .groupBy(F.col("u").alias("node")).agg(F.min("component").alias("near")))
        hooked = labels.join(near, "node").select("node", F.col("component").alias("old"),
                                                  F.least("component", "near").alias("mid"))
        jumps = hooked.select(F.col("node").alias("mid"), F.col("mid").alias("component"))
        step = cut(hooked.join(jumps, "mid").select("node", "old", "component"))
        if step.where("old <> component").isEmpty():
            return step.select("node", "component")
        labels = step.select("node", "component")
