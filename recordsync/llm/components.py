"""Connected components as Spark joins: alternating large-star and small-star steps.

Every node hooks onto the smallest node that it knows of; a step is a
group-by and a join over the edges, written to the shared folder.  The number
of steps grows with the logarithm of a component's diameter.  No edge list
comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _hooked(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Each neighbour (above the node itself, if ``larger_only``) linked to the least of node and neighbours."""
    if larger_only:
        seen = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        seen = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = seen.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = seen.join(least, "a")
    if larger_only:
        made = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        made = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return made.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of an edge (a, b) with the smallest node reachable from it."""
    now = written(edges.where("a <> b").select(F.col("a").cast("long"), F.col("b").cast("long")).distinct())
    mark = None
    while True:
        now = written(_hooked(_hooked(now, True), False))
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == mark:
            break
        mark = tuple(state)
    return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
