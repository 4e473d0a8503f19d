"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def _stars(links: DataFrame, smaller_only: bool) -> DataFrame:
    """Hang neighbours on the smallest node among them; minima are aggregates, nothing is collected."""
    if smaller_only:  # links go from the larger node to the smaller
        directed = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        directed = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = directed.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    hung = directed.join(least, "u")
    if smaller_only:
        own = least.select(F.col("u").alias("v"), "m")
        return hung.select("v", "m").unionByName(own).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    return hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (``u``, ``v``) but the roots: the smallest node reachable.

    Alternating large and small stars: the table never grows beyond its links and its nodes,
    a logarithmic number of rounds is enough even for chains, and each round is a stored table.
    """
    now = stored(links.where("u <> v").distinct(), "links")
    before = None
    while True:
        now = stored(_stars(_stars(now, False), True), "stars")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark
