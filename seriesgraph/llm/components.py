"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole_if_small, written


def _lowest(edges: DataFrame) -> DataFrame:
    """Each u's smallest v. Written: the join back sends it whole where it is small, else it is of two plain exchanges,
    which Spark splits where a hub is hot."""
    return whole_if_small(written(edges.groupBy("u").agg(F.min("v").alias("m")), "lowest"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _lowest(both).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """edges run from larger to smaller."""
    low = _lowest(edges)
    linked = edges.join(low, "u")
    out = linked.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with a link to another; component is the smallest node reachable.

    Rounds until only stars around smallest nodes are left, their number logarithmic in the longest path; each round's
    links are a written table. Nulls and self links are ignored; no links give no rows.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct()
    edges = written(edges, "edges")
    while not _stars(edges):
        edges = written(_small_star(written(_large_star(edges), "large")), "small")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end has one link, and no smaller end is a larger one too."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1 and up > 0").isEmpty()
