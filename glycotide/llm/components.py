"""Connected components of an edge table, by rounds of contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glycotide.llm.shared import written


def components(edges: DataFrame) -> DataFrame:
    """id, component (smallest id reachable) of each id in ``edges`` (a, b: longs; loops and repeats are fine).

    In each round a node joins its neighbour of the smallest hash, or stays; edges between what became one node go. Hashes
    differ by round, so a share of all nodes goes each time, whatever the shape. An empty table gives an empty table.
    """
    edges = written(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    nodes = written(edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct().withColumn("node", F.col("id")), "nodes")
    number = 0
    while edges.head(1):
        number += 1
        rank = lambda c: F.struct(F.xxhash64(F.lit(number), F.col(c)), F.col(c).alias("id"))
        both = edges.select("a", "b").union(edges.select("b", "a"))
        into = written(both.groupBy("a").agg(F.min(rank("b")).alias("low")).select(
            F.col("a").alias("old"), F.when(F.col("low") < rank("a"), F.col("low.id")).otherwise(F.col("a")).alias("new")), "into")
        nodes = written(nodes.join(into, F.col("node") == F.col("old"), "left").select("id", F.coalesce("new", "node").alias("node")), "nodes")
        half = edges.join(into, F.col("a") == F.col("old")).select(F.col("new").alias("a"), "b")
        edges = written(half.join(into, F.col("b") == F.col("old")).select("a", F.col("new").alias("b")).filter("a <> b").distinct(), "edges")
    smallest = nodes.groupBy("node").agg(F.min("id").alias("component"), F.count("*").alias("members"))
    return nodes.join(smallest, "node").select("id", "component")
