"""Connected components of an edge table by alternating large and small stars; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

MOST_ROUNDS = 60


def _least_neighbour(edges: DataFrame, side: str, other: str) -> DataFrame:
    return edges.groupBy(side).agg(F.min(other).alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Joins every larger neighbour of a node to the node's least neighbour (or the node itself)."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least_neighbour(both, "u", "v").withColumn("least", F.least("least", "u"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Joins a node and its smaller neighbours to the least of these; edges run from larger to smaller."""
    least = _least_neighbour(edges, "u", "v")
    near = edges.join(least, "u").where(F.col("v") > F.col("least")).select(F.col("v").alias("u"), F.col("least").alias("v"))
    return near.unionByName(least.select("u", F.col("least").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """node and root, the least node of its component, of all nodes that have an edge. edges: columns u and v of one
    integer type, in any order, repeats and loops allowed; rows with a null are left out."""
    now = edges.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    now = checkpointed(now.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    for _ in range(MOST_ROUNDS):
        sign = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == mark or not sign[0]:
            break
        mark = sign
        now = checkpointed(_small_star(_large_star(now)).distinct())
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
