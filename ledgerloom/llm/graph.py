"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.session import materialize


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one link down, or only links up."""
    sides = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    sides = sides.unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    counts = sides.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return counts.where("down > 1 OR (down = 1 AND up = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``); the component is its smallest
    node.

    Large-star and small-star steps (Kiveris et al. 2014): each is an aggregate and an equi-join,
    so no node's neighbours are ever gathered, and the number of rounds grows with the logarithm
    of a path, not with its length. Every round ends in a written table.
    """
    linked = edges.where(F.col("a") != F.col("b"))
    stars = linked.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    stars = materialize(stars, "stars")
    while not _are_stars(stars):
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v"))
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").where(F.col("v") != F.col("m"))
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = small.unionByName(lower.select("u", F.col("m").alias("v"))).distinct()
        stars = materialize(stars, "stars")
    roots = stars.select(F.col("v").alias("node")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
