"""Connected components of a link table by alternating star contraction.

A large-star step links every larger neighbour of a vertex to the smallest of
its neighbourhood, a small-star step every smaller one; repeated, they leave
stars around each component's smallest vertex.  A step is a minimum per vertex
(combined before the shuffle) and a join back, never a window over all links of
a vertex.  The minima are written before they are joined: joined as they are, they
would tie all links of a vertex to one task, while a join of two stored tables is
one whose large partitions adaptive execution splits.  Every round is written to the
shared folder, which cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _fingerprint(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(vertex, component) of every linked vertex but the smallest ones, which
    are their own component.  Ids are longs; null ends and loops are ignored."""
    pair = links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u != v").distinct()
    edges = cut(pair, "links")
    mark = _fingerprint(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least-neighbour")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut(large.where("u != v").distinct(), "large-star")
        low = cut(large.groupBy("u").agg(F.min("v").alias("m")), "least-smaller")
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = cut(small.where("u != v").distinct(), "small-star")
        new = _fingerprint(edges)
        if new == mark:
            return edges.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
        mark = new
