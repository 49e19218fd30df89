"""A keyed log kept in levels, so that a micro-batch reads little however many came before it.

Each micro-batch adds a segment of its own, with rows in folders by key bucket; ``fan`` segments of a level are merged into
one of the next, so ``n`` micro-batches leave some ``fan * log(n)`` segments and a row is rewritten ``log(n)`` times.  The
list of segments is a version of its own (one row, one file): readers see the segments of a version, writers add a new
version, and an epoch that a version already holds changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

_STATE = "segments array<struct<name:string, level:int, rows:bigint, epochs:array<struct<first:bigint, last:bigint>>>>"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _spans(epochs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(epochs):
        if out and first <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(out[-1][1], last)
        else:
            out.append((first, last))
    return out


class Levels:
    """Segments of rows of ``schema``, which has the column ``bucket``, under ``root``.

    ``merge`` makes one segment's rows of several segments' (with the column ``segment``, oldest first by number);
    ``written`` is called with each new segment's name, path and number of rows, for what goes with a segment.
    """

    def __init__(self, root: str, schema: str, merge: Callable[[DataFrame], DataFrame], fan: int = 4,
                 written: Callable[[SparkSession, str, str, int], None] | None = None):
        self.root, self.schema, self.merge, self.fan, self.written = root.rstrip("/"), schema, merge, fan, written

    def path(self, segment: str) -> str:
        return f"{self.root}/segments/{segment}"

    def _versions(self, spark: SparkSession) -> list[int]:
        """Numbers of the versions there are (a listing of names, no file is read)."""
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_versions")
        fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(hadoop):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(hadoop)]
        return sorted(int(n[3:]) for n in names if n.startswith("at="))

    def segments(self, spark: SparkSession) -> list[Row]:
        """The segments of the last version, oldest first."""
        for version in reversed(self._versions(spark)):
            rows = spark.read.schema(_STATE).json(f"{self.root}/_versions/at={version}").collect()
            if rows:  # else cut off while it was written
                return rows[0].segments
        return []

    def holds(self, spark: SparkSession, epoch: int) -> bool:
        return any(e.first <= epoch <= e.last for s in self.segments(spark) for e in s.epochs)

    def add(self, epoch: int, rows: DataFrame) -> bool:
        """``rows`` as the segment of an epoch; False if that epoch is there."""
        spark = rows.sparkSession
        if self.holds(spark, epoch):
            return False
        now = [s.asDict(recursive=True) for s in self.segments(spark)]
        now.append(self._write(spark, rows, 0, [(epoch, epoch)]))
        level = 0
        while len(full := [s for s in now if s["level"] == level]) >= self.fan:
            epochs = _spans([(e["first"], e["last"]) for s in full for e in s["epochs"]])
            merged = self._write(spark, self.merge(self._read(spark, [s["name"] for s in full])), level + 1, epochs)
            at = now.index(full[-1])
            now[at] = merged
            now = [s for s in now if s not in full]
            level += 1
        version = max(self._versions(spark), default=-1) + 1
        kept = [(s["name"], s["level"], s["rows"], [(e["first"], e["last"]) for e in s["epochs"]]) for s in now]
        spark.createDataFrame([(kept,)], _STATE).coalesce(1).write.mode("overwrite").json(f"{self.root}/_versions/at={version}")
        return True

    def _write(self, spark: SparkSession, rows: DataFrame, level: int, epochs: list[tuple[int, int]]) -> dict:
        name = f"{level}-{uuid.uuid4().hex}"
        rows = cut_lineage(rows)
        n = rows.count()
        rows.repartition("bucket").write.partitionBy("bucket").parquet(self.path(name))
        if self.written:
            self.written(spark, name, self.path(name), n)
        return {"name": name, "level": level, "rows": n, "epochs": [{"first": a, "last": b} for a, b in epochs]}

    def _read(self, spark: SparkSession, names: list[str]) -> DataFrame:
        parts = [spark.read.schema(self.schema).parquet(self.path(name)).withColumn("segment", F.lit(number))
                 for number, name in enumerate(names)]
        return reduce(DataFrame.unionByName, parts)

    def rows(self, spark: SparkSession, buckets: list[int] | None = None) -> DataFrame | None:
        """All segments' rows with ``segment`` (oldest first by number), of some buckets only where they are given: then no
        other folders are read.  None if there are no segments."""
        found = [s.name for s in self.segments(spark) if s.rows]
        if not found:
            return None
        every = self._read(spark, found)
        return every if buckets is None else every.where(F.col("bucket").isin(buckets))

    def prune(self, spark: SparkSession, keep: int = 2) -> int:
        """Delete the segments that none of the last ``keep`` versions lists, and older versions; how many segments."""
        versions = self._versions(spark)
        used: set[str] = set()
        for version in versions[-keep:]:
            for row in spark.read.schema(_STATE).json(f"{self.root}/_versions/at={version}").collect():
                used |= {s.name for s in row.segments}
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/segments")
        fs = folder.getFileSystem(conf)
        gone = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName() not in used] if fs.exists(folder) else []
        for path in gone:
            fs.delete(path, True)
        for version in versions[:-keep]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.root}/_versions/at={version}"), True)
        return len(gone)
