"""Connected components by contraction, in a logarithmic number of rounds; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanloom.llm.base import cut

JUMPS = 2


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for every node in ``links`` (columns ``a``, ``b``, bigint)."""
    edges = cut(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = nodes.select("node", F.col("node").alias("component"))
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parent = both.groupBy("a").agg(F.min("b").alias("near")).select(F.col("a").alias("u"), F.least("a", "near").alias("p"))
        for _ in range(JUMPS):
            up = parent.select(F.col("u").alias("x"), F.col("p").alias("higher"))
            parent = parent.join(up, F.col("p") == F.col("x")).select("u", F.col("higher").alias("p"))
        parent = cut(parent)
        labels = labels.join(parent, F.col("component") == F.col("u"), "left").select("node", F.coalesce("p", "component").alias("component"))
        one = edges.join(parent, F.col("a") == F.col("u")).select(F.col("p").alias("a"), "b")
        two = one.join(parent, F.col("b") == F.col("u")).select("a", F.col("p").alias("b")).filter("a <> b")
        edges = cut(two.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        labels = cut(labels)
    return labels
