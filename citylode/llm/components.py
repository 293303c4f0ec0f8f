"""Connected components of a graph by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylode.llm.common import stored


def flatten(spark: SparkSession, parents: DataFrame) -> DataFrame:
    """Point every node of a forest (node, root) at the root of its tree; halves the depth per round."""
    while True:
        up = parents.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = stored(spark, parents.join(up, "root", "left").select(
            "node", F.coalesce("above", "root").alias("root"),
            (F.coalesce("above", "root") != F.col("root")).alias("moved")), "jump")
        parents = jumped.select("node", "root")
        if jumped.filter("moved").isEmpty():
            return parents


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node reachable.

    Each round hooks every node to its smallest neighbour if that is smaller, flattens the trees, and
    keeps only edges between different roots, so nodes at least halve in every round with edges. A star
    of any size takes one round. Only counts reach the driver.
    """
    edges = stored(spark, edges.filter("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while labels is None or not edges.isEmpty():
        both = edges.select(F.col("b").alias("node"), F.col("a").alias("near")).unionByName(
            edges.select(F.col("a").alias("node"), F.col("b").alias("near")))
        hooked = both.groupBy("node").agg(F.min("near").alias("near")).select(
            "node", F.least("node", "near").alias("root"))
        roots = flatten(spark, stored(spark, hooked, "hooks"))
        if labels is None:
            labels = roots
        else:
            step = roots.select(F.col("node").alias("root"), F.col("root").alias("above"))
            labels = stored(spark, labels.join(step, "root", "left").select(
                "node", F.coalesce("above", "root").alias("root")), "labels")
        a = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = stored(spark, edges.join(a, "a").join(b, "b").filter("ra <> rb").select(
            F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
    return labels
