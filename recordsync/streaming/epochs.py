"""Several tables that a micro-batch changes as one, and ids that go on over micro-batches.

Everything is plain files under one root on shared storage.  A table's rows of an epoch go to a folder of that attempt;
the epoch counts once its manifest is there, a dataset of one row in one file, so readers see all of an epoch's tables or
none.  An attempt that was cut off leaves folders that no manifest names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Row, SparkSession

from ..operators.quality import error_log_rows

_MANIFEST = "epoch bigint, attempt string, tables array<string>"
_BLOCK = "epoch bigint, first bigint, count bigint"


def one_row_datasets(spark: SparkSession, path: str, schema: str) -> list[Row]:
    """The rows of datasets ``path``/at=N of one row each (one per epoch: a list the driver can hold)."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", "true").json(path).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def write_one_row(spark: SparkSession, path: str, at: int, row: tuple, schema: str) -> None:
    """One file, moved into place as a whole when the job commits."""
    spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").json(f"{path}/at={at}")


class EpochTables:
    """Tables under ``root`` that grow by epochs."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def manifests(self, spark: SparkSession) -> dict[int, Row]:
        return {r.epoch: r for r in one_row_datasets(spark, f"{self.root}/_epochs", _MANIFEST)}

    def write(self, spark: SparkSession, epoch: int, tables: dict[str, DataFrame]) -> bool:
        """All of ``tables`` as one epoch; False, and nothing is written, if that epoch is there."""
        if epoch in self.manifests(spark):
            return False
        attempt = uuid.uuid4().hex
        with ThreadPoolExecutor(4) as pool:  # independent jobs
            list(pool.map(lambda name: self.write_table(tables[name], f"{self.root}/{name}/epoch={epoch}/attempt={attempt}"), tables))
        write_one_row(spark, f"{self.root}/_epochs", epoch, (epoch, attempt, sorted(tables)), _MANIFEST)
        return True

    @staticmethod
    def write_table(rows: DataFrame, path: str) -> None:
        rows.write.mode("errorifexists").parquet(path)

    def read(self, spark: SparkSession, name: str, schema, before: int | None = None) -> DataFrame:
        """The rows of all epochs that count (or of those before one), with the column ``epoch``."""
        paths = [f"{self.root}/{name}/epoch={e}/attempt={m.attempt}" for e, m in sorted(self.manifests(spark).items())
                 if name in m.tables and (before is None or e < before)]
        if not paths:
            return spark.createDataFrame([], schema).selectExpr("*", "CAST(NULL AS bigint) AS epoch")
        rows = spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*paths)
        return rows.drop("attempt").withColumn("epoch", rows["epoch"].cast("bigint"))


class IdLedger:
    """Blocks of consecutive ids, one per epoch, on storage.

    An epoch's first claim takes the block after the last one; a replay of the epoch finds its own block again.  As a
    stream replays an epoch until it is done, with the same rows, no id is left out or given twice.
    """

    def __init__(self, root: str, name: str, start: int):
        self.path, self.start = f"{root.rstrip('/')}/_ids/{name}", start

    def claim(self, spark: SparkSession, epoch: int, count: int) -> int:
        """The id before the epoch's first one."""
        blocks = {b.epoch: b for b in one_row_datasets(spark, self.path, _BLOCK)}
        if epoch in blocks:
            if blocks[epoch]["count"] != count:
                raise ValueError(f"epoch {epoch} claimed {blocks[epoch]['count']} ids before and {count} now: not the same rows")
            return blocks[epoch].first
        first = max([self.start, *(b.first + b["count"] for b in blocks.values())])
        write_one_row(spark, self.path, epoch, (epoch, first, count), _BLOCK)
        return first

    def for_epoch(self, spark: SparkSession, epoch: int) -> Callable[[int], int]:
        return lambda count: self.claim(spark, epoch, count)


class ErrorLogSink:
    """S17/M18 per micro-batch: rejects as rows of the error log, numbered on from ``start`` without a gap."""

    def __init__(self, root: str, start: int, code: int, info, order: list[str]):
        self.tables, self.ids = EpochTables(root), IdLedger(root, "error_log", start)
        self.code, self.info, self.order = code, info, order

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        if epoch not in self.tables.manifests(spark):
            rows = error_log_rows(batch, None, self.code, self.info, order=self.order, claim=self.ids.for_epoch(spark, epoch))
            self.tables.write(spark, epoch, {"error_log": rows})

    def log(self, spark: SparkSession, schema) -> DataFrame:
        return self.tables.read(spark, "error_log", schema)
