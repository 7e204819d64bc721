"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from squall.llm.common import stage

MAX_ROUNDS = 60


def connected(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): the smallest node that
    it reaches.

    Rounds of large stars (neighbours above a node point to its least
    neighbour) and small stars (those below do) end in one star per component;
    each round is a written table, so a lost executor costs one round at most.
    The number of rounds grows with the logarithm of the longest path.
    """
    edges = stage(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"),
                                                              F.least("a", "b").alias("v")).distinct(), "cc")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    mark = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where(F.col("u") != F.col("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct("u", F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct())
        edges = stage(small, "cc")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        mark = now
    raise RuntimeError("components did not settle")
