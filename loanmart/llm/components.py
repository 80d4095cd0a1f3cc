"""Connected components by alternating stars, each round a few joins over the edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loanmart.llm.shared import written


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; root is the component's smallest node.

    A round hangs larger neighbours of a node on its smallest neighbour, then smaller ones, which
    keeps components as they are and halves their depth, so rounds grow with the logarithm of the size.
    Nothing reaches the driver but a count and a checksum a round.
    """
    edges = written(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    seen = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # every node that has a smaller neighbour keeps an edge, as the smallest one hangs on it
        large = large.where("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(small.union(lowest).where("a <> b").distinct())
        now = edges.select(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38)"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
