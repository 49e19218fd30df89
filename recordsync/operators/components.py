"""Connected components by joins: rounds of star contraction (logarithmically many), no row ever meets all its kin.

Few links, of a micro-batch say, are not worth the rounds: up to a documented number one task joins them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


#: Links (of 16 bytes) that one task takes; more are contracted by joins.
IN_ONE_TASK = 500_000


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of links (a, b), the component named by its least node."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]  # halves the way
            x = root[x]
        return x

    for batch in batches:
        for a, b in zip(*[c.to_pylist() for c in batch.columns]):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    yield pa.RecordBatch.from_pydict({"node": pa.array(list(root), pa.int64()), "component": pa.array([find(x) for x in root], pa.int64())})


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for each node of ``edges`` (a, b: long) the least node that links lead to.

    Every round links a node's greater neighbours, then its lesser ones, to the least of its neighbourhood.  The least
    is a partial aggregate of one row per node, so a node with a third of the edges costs a row per task, and the join
    back to its edges is one that AQE can split.
    """
    def both(e: DataFrame) -> DataFrame:
        return e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def stars(e: DataFrame) -> bool:
        """Whether every node is linked to one node, which is linked to no lesser one."""
        centres = e.select("b").distinct().withColumnRenamed("b", "a")
        n, nodes = e.agg(F.count("*"), F.count_distinct("a")).first()
        return n == nodes and e.join(centres, "a", "left_semi").isEmpty()

    current = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    if current.count() <= IN_ONE_TASK:
        return cut_lineage(current.coalesce(1).mapInArrow(_joined, "node long, component long"))
    while not stars(current):
        large = both(current)
        least = large.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        grown = large.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        root = grown.groupBy("a").agg(F.min("b").alias("m"))
        shrunk = grown.join(root, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").unionByName(
            root.select("a", F.col("m").alias("b")))
        current = cut_lineage(shrunk.distinct())
    found = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())
