"""Connected components of a link table by alternating star contraction, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def _large_star(links: DataFrame) -> DataFrame:
    """Point every larger neighbour of a node at the smallest node around it."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(links: DataFrame) -> DataFrame:
    """Point a node and its smaller neighbours at the smallest of them; links run from large to small."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b")


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` for each node of ``links`` (columns ``a``, ``b`` of one orderable type).

    ``root`` is the smallest node reachable.  Links to itself and repeats are ignored; nulls are not
    nodes; an empty table gives an empty result.  Rounds are logarithmic in the longest path; each is
    written to the shared folder, and only its row count and checksum reach the driver.
    """
    links = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = None
    while True:
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == mark:
            break
        mark, before = now, links
        links = stored(_small_star(_large_star(links).distinct()).distinct(), "links")
        discard(before)
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
