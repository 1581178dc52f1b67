"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficspark.llm import common


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """node, component (its least reachable node) for every node of links (a, b), isolated nodes apart.

    Each round hangs every node's greater neighbours, then its lesser ones, on the least node around it; the
    links turn into stars in a number of rounds that grows with the logarithm of the longest path. Rounds are
    written to the shared folder, each until the next is; only a count and a checksum reach the driver.
    """
    edges = links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = common.stored(edges, name), None
    while True:
        count, check = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (count, check) == before or not count:
            break
        before = (count, check)
        # Large star: the greater neighbours of each node go to the least of it and its neighbours.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()
        # Small star: each node and its lesser neighbours go to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.select("a", F.col("least").alias("b"))).where("a <> b").distinct()
        last, edges = edges, common.stored(small, name)
        common.forget(last)
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
