"""Connected components of an edge table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationqc.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node that each node of edges (a, b: long) can reach.

    Each round takes the least label among a node and its neighbours, and then that label's own label, so chains shorten by half.
    Rounds end when no label changes; each is a table in the shared folder. A node with very many edges is combined before it is moved.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct())
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("component")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        nearest = labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("label"))
        nearest = written(nearest)
        jump = nearest.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = written(nearest.join(jump, "label", "left").select("node", "was", F.least("label", F.coalesce("next", "label")).alias("component")))
        if labels.filter("was <> component").isEmpty():
            return labels.select("node", "component")
        labels = labels.select("node", "component")
