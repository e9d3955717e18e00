"""Connected components over an edge table, by alternating star contraction.

Large star links every larger neighbour of a node to the node's least neighbour; small
star does so for the smaller ones. Rounds alternate until the edges stop changing, which
takes a number of rounds logarithmic in the longest chain. A node's least neighbour is a
combinable aggregate and neighbours are never gathered; every round ends in a checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import cut


def star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges``: (u, v) with u > v."""
    both = edges if not large else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    linked = both.join(least, "u")
    if large:
        moved = linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def mark(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for every node that has an edge and is not the least of its component."""
    now = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct())
    seen = mark(now)
    while seen[0]:
        now = cut(star(star(now, large=True), large=False))
        last, seen = seen, mark(now)
        if seen == last:
            break
    return now.withColumnRenamed("v", "root")
