"""Connected components of a graph held as a table of links.

Alternating star contractions: every node hooks its larger neighbours, then its smaller ones, onto the least node it
knows. Each round is two joins on a table of at most as many links as before; the rounds grow with the logarithm of the
longest chain. Links never reach the driver, and each round is a written table, so lost executors cost one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(links: DataFrame) -> DataFrame:
    """``links``: a, b (bigint, not null). Returns node and root (the least node of its component) of every node with a link."""
    links = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: the larger neighbours of each node go to the least node around it
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "large-star")
        # small star: the smaller neighbours and the node itself go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        links = materialize(small.where("u <> v").distinct(), "small-star")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
