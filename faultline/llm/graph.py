"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import stored


def stars(e: DataFrame) -> bool:
    """Whether the distinct edges (a, b), a > b, are stars around their smallest
    nodes: every a has one edge down and is no other's b. A round leaves those
    edges, and only those, as they are."""
    ends = e.select(F.col("a").alias("u"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        e.select("b", F.lit(0), F.lit(1)))
    return not (ends.groupBy("u").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
                .where("down > 1 or down > 0 and up > 0").limit(1).count())


def components(edges: DataFrame, name: str = "edges") -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): label is the smallest
    node of its component.

    Large-star and small-star in turn: every node links its neighbours to the
    smallest one, which halves distances each round, until the edges form stars.
    Smallest neighbours come from an aggregate and a join, so a node with very
    many neighbours is never gathered; each round is written to shared storage.
    Stars need no round, neither to begin with nor to see that nothing changes.
    """
    e = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .where("a <> b").distinct(), f"{name}-0")
    i = 0
    while not stars(e):
        # large-star: neighbours above a node go to the smallest of its surroundings
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        low = stored(low, f"{name}-low{i}")  # a plain table: Spark may split the join's large partitions
        large = both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        # small-star: a node and its neighbours below it go to the smallest of them
        large = stored(large.distinct(), f"{name}-large{i}")
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), f"{name}-least{i}")
        small = (large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b")))).distinct()
        i += 1
        e = stored(small, f"{name}-{i}")
    return e.select(F.col("a").alias("node"), F.col("b").alias("label")).union(e.select("b", "b").distinct())
