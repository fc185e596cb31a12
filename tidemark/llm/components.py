"""Connected components of an edge table, by alternating star contraction.

Every step is a grouped minimum and a join, so no component is gathered anywhere. A node with
very many neighbours is combined before the shuffle in the first and split by adaptive
execution in the second. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def mark(edges: DataFrame):
    """Size and order-free checksum of an edge set."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    """``u`` is the larger end."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    ends = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return ends.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of all nodes with an edge; the component is its least node.

    ``edges`` has ``u`` and ``v``; order, repeats, loops and nulls do not matter.
    """
    stars = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    stars = stored(stars)
    before = mark(stars)
    while before[0]:
        stars = stored(small_star(large_star(stars)).distinct())
        after = mark(stars)
        if after == before:
            break
        before = after
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
