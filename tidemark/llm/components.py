"""Connected components of a table of links, by joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``a, b`` links; the component is its least node.

    Each round takes the least label among a node's neighbours, then follows labels once, so
    the distance covered doubles. Every round is written: the lineage stays short, and joins
    start from files, so that a node with a third of all links can be split.
    """
    edges = materialise(links.select("a", "b").unionByName(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = materialise(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
                         .select("node", F.least("node", "near").alias("component")), "labels")
    while True:
        heard = (edges.join(labels, F.col("a") == F.col("node")).groupBy(F.col("b").alias("told"))
                 .agg(F.min("component").alias("least")))
        taken = materialise(labels.join(heard, F.col("node") == F.col("told"))
                            .select("node", F.col("component").alias("old"),
                                    F.least("component", "least").alias("component")), "heard")
        roots = taken.select(F.col("node").alias("via"), F.col("component").alias("root"))
        new = materialise(taken.join(roots, F.col("component") == F.col("via"))
                          .select("node", "old", F.col("root").alias("component")), "labels")
        if new.where("old <> component").isEmpty():
            return new.select("node", "component")
        labels = new.select("node", "component")
