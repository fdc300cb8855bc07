"""Connected components of an edge list by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a node is hung on the least node around it."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    greater = both.filter("v > u").join(least, "u")
    return greater.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its lesser neighbours are hung on the least of these neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of an edge, ``root`` being the least node of its component.

    ``edges`` has two columns of one ordered type; loops, repeats and either direction are fine. A
    round is two aggregations and two joins on a node, and the number of rounds grows with the
    logarithm of the longest chain. Each round is written to the shared folder, so a lost executor
    costs one round and the plan stays short. Only two numbers a round reach the driver.
    """
    first, second = edges.columns
    current = materialize(
        edges.select(F.greatest(first, second).alias("u"), F.least(first, second).alias("v"))
        .filter("u <> v").distinct(),
        "edges",
    )
    print_of = [F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
    seen = current.agg(*print_of).first()
    while seen[0]:
        current = materialize(_small_star(_large_star(current)), "edges")
        now = current.agg(*print_of).first()
        if now == seen:
            break
        seen = now
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return nodes.unionByName(roots)
