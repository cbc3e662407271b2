"""Connected components of a link table by alternating stars, with every step a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalgrid.llm.common import stage
from shoalgrid.operators.skew import lookup


def _large_star(links: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the least of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return lookup(both, least, ["u"], "inner").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the least of these."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    hung = lookup(links, least, ["u"], "inner").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (two columns of longs); the root is the least node reachable.

    A null end or a link of a node to itself is left out. Stars are joined, never gathered, so a node
    may have any number of links; each round is staged, and a few rounds suffice (log of the diameter).
    """
    a, b = links.columns
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    seen = None
    while True:
        links = stage(_small_star(_large_star(links)), "stars")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = links.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
