"""Connected components of a link table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.shared import stored


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksum of an edge table."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node reachable) for every node of a link between two different nodes.

    Each round links every node's larger neighbours, then its smaller ones, to the smallest of them, until
    nothing changes: the number of rounds grows with the logarithm of the longest chain.  Minima are
    combined before they are shuffled, and every round is written to the shared folder.  An empty table has
    no components; null ends and links of a node to itself say nothing.
    """
    ends = [F.col(a).cast("long"), F.col(b).cast("long")]
    edges = links.where(F.col(a) != F.col(b)).select(F.greatest(*ends).alias("u"), F.least(*ends).alias("v"))
    edges = stored(edges.distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
