"""Connected components of a graph given by its edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import durable


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (a, b) reaches.

    Large star: every neighbour above a node is tied to the smallest neighbour; small star: every neighbour below it. Both
    are a minimum per node (partial sums) and a join, and need a number of rounds logarithmic in the longest path; a
    round's edges are a written table. A node of any degree is spread over tasks, since the joins are on rows."""
    edges = durable(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.join(lowest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.filter("a != b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lowest, "a")
        tied = small.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(lowest.select("a", F.col("low").alias("b")))
        edges = durable(tied.filter("a != b").distinct(), "edges")
        # at the end all edges lead to the smallest node: none starts where another ends, and nothing moves any more
        now = edges.agg(F.count("*"), F.sum(F.col("a").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
