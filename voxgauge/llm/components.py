"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from voxgauge.llm.shared import stored


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: long); nodes in one component share ``component``.

    In each round every node is merged into the least of itself and its neighbours, and edges join what is left, until
    none is. Ids should be in no order that follows the edges; then the nodes fall by a constant factor per round.
    Neighbours are combined before the shuffle, so a node of very many edges is no burden. No edges: no rows.
    """
    edges = stored(spark, "edges", edges.filter("a <> b").distinct())
    steps = []
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        step = both.groupBy("node").agg(F.min("other").alias("least"))
        step = stored(spark, "merged", step.select("node", F.least("node", "least").alias("into")))
        steps.append(step)
        left = step.select(F.col("node").alias("a"), F.col("into").alias("x"))
        right = step.select(F.col("node").alias("b"), F.col("into").alias("y"))
        merged = edges.join(left, "a").join(right, "b").filter("x <> y")
        merged = merged.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        edges = stored(spark, "edges", merged)
    if not steps:
        return spark.range(0).select(F.col("id").alias("node"), F.col("id").alias("component"))
    found = steps[0].select("node", F.col("into").alias("component"))
    for step in steps[1:]:
        next_ = step.select(F.col("node").alias("component"), "into")
        found = found.join(next_, "component", "left").select("node", F.coalesce("into", "component").alias("component"))
    return found
