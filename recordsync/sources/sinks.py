"""Sinks: queue files, snapshot versions, outbound tables.

Writes go to the shared storage the cluster names; every write creates a new
directory (version), so a path is never overwritten while it is read and a
retried job is idempotent (same input -> same version content).
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_queue(df: DataFrame, path: str) -> str:
    """JSON-lines batch, every part file kept (Q6), NULL fields written."""
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)
    return path


def write_snapshot(df: DataFrame, root: str, version: str) -> str:
    """S12/M-ops: a new table version under ``root`` (swap = point readers at it)."""
    path = f"{root.rstrip('/')}/v={version}"
    df.write.mode("errorifexists").parquet(path)
    return path


def append_rows(df: DataFrame, path: str) -> str:
    """Bulk append (error log, missing-field log).  Row-at-a-time
    inserts of the source become this one append; per-row failure isolation
    is the validity split done before it (``quality.split_valid``)."""
    df.write.mode("append").parquet(path)
    return path


def write_jdbc(df: DataFrame, settings: dict, table: str, mode: str = "append", batchsize: int = 200,
               truncate: bool = False) -> None:
    """Bulk JDBC write; ``truncate`` keeps the table definition on overwrite."""
    from .readers import jdbc_options
    w = df.write.format("jdbc").options(**jdbc_options(settings)).option("dbtable", table) \
        .option("batchsize", batchsize).mode(mode)
    if truncate:
        w = w.option("truncate", "true")
    w.save()


def register_staging(df: DataFrame, name: str) -> DataFrame:
    """Session-scoped staging table (the source's temporary table) as a
    temp view over the lazily evaluated frame."""
    df.createOrReplaceTempView(name)
    return df
