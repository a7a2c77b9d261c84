"""Connected components of a distributed edge list by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.session import cut


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable, for every node that differs from it.

    ``edges`` has columns a and b. Each round first hangs the larger neighbours of every node below the smallest
    one, then the smaller ones; both are a minimum per node (combined before the shuffle) and a join, so
    a node with very many neighbours is no burden on one task. Rounds grow with the logarithm of the largest
    component. Every round is written to the shared folder, nothing but a count and a checksum is collected.
    """
    now = cut(_oriented(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))), "stars")
    seen = _mark(now)
    while seen[0]:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(_oriented(hung.unionAll(lowest.select("u", F.col("m").alias("v")))), "stars")
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _oriented(pairs: DataFrame) -> DataFrame:
    return pairs.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
