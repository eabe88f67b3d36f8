"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (a, b): the smallest node it is connected with.

    Alternates large and small stars: each node hands its larger neighbours, then its smaller
    ones, to the least node it sees, until only stars around the least nodes are left. Every
    step is a grouped minimum and a join, so that a node with very many edges is no task's
    own. Self-loops keep their node in the result.
    """
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).filter("node is not null").distinct()
    stars = checkpointed(_ordered(edges))
    while True:  # until only stars are left; the number of rounds is logarithmic
        # A node that is the lower end of one edge and the upper one of another is no star's tip yet.
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ends = both.groupBy("a").agg(F.min("b").alias("low"), F.max("b").alias("high"), F.count_if(F.col("b") < F.col("a")).alias("lower"))
        if ends.filter((F.col("low") < F.col("a")) & ((F.col("high") > F.col("a")) | (F.col("lower") > 1))).isEmpty():
            break
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
        # large star: neighbours above a node go to the least node that it sees
        large = both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        # small star: a node and its smaller neighbours go to the least of them
        lower = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(lower, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        stars = checkpointed(_ordered(small.unionByName(lower.select("a", F.col("least").alias("b")))))
    return nodes.join(stars.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges with the larger node first, without loops."""
    pairs = edges.filter(F.col("a") != F.col("b"))
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
