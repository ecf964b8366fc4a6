"""Connected components of a link table by label propagation with shortcuts, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.llm import common


def components(links: DataFrame, folder: str) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node that can be reached.

    Each round turns the links into stars around the smallest neighbour (large star, then small star), which needs a
    number of rounds in the order of the logarithm of the longest path. Every round is written to ``folder``.
    A node of many links is reduced to its minimum by a map-side aggregate; its links are never gathered.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    step, before = 0, None
    edges = common.stored(edges, f"{folder}/cc-0")
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Large star: each neighbour above a node is linked to the node's minimum.
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: the lower neighbours of a node, and the node, are linked to their minimum.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.a", "e.b").where("a <> b").distinct()
        step += 1
        edges = common.stored(small, f"{folder}/cc-{step}")
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == before:
            leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            return leaves.union(edges.select("b", "b").distinct())
        before = tuple(mark)
