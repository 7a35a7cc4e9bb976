"""Connected components of a table of links, by alternating large and small stars.

Every step is a grouped minimum and a join, cut by a written table; a hub with
very many neighbours is pre-aggregated before the shuffle, and the join's hot key
is split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stormledger.runtime import cut_at, drop_scratch


def _large_star(links: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the least node it knows."""
    both = links.select("a", "b").union(links.select("b", "a"))
    least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    met = both.filter("b > a").join(least, F.col("a") == F.col("u"))
    return met.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours, and itself, to the least of them. Links go from larger to smaller."""
    least = links.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    met = links.join(least, F.col("a") == F.col("u"))
    moved = met.filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("u", "m")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); the component is its least node.

    Links of a node with itself do not count. Written; the caller may drop nothing.
    """
    spark = links.sparkSession
    held, path = cut_at(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        now = held.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return held.select(F.col("a").alias("node"), F.col("b").alias("component")).union(held.select("b", "b").distinct())
        state, old = now, path
        held, path = cut_at(_small_star(_large_star(held)), "links")
        drop_scratch(spark, old)
