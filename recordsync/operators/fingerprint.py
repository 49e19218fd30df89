"""Change fingerprints.

The source computed one MD5 over all rows collected to the driver, so the
hash depended on row order and NULLs vanished from ``concat_ws``.  Here a
dataset fingerprint is an order-free, distributed aggregate: each row gets an
MD5 with NULLs marked, its first 15 hex digits become an integer, and the
dataset digest is (row count, sum of those integers) — the same for any row
order or partition count, computed with partial aggregation and a single
tiny final shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import row_fingerprint


def with_row_fingerprint(df: DataFrame, cols: list[str] | None = None, out: str = "fingerprint") -> DataFrame:
    """Add the MD5 row fingerprint over ``cols`` (default: all columns, in order)."""
    cols = cols or df.columns
    return df.withColumn(out, row_fingerprint(*cols))


def fingerprint_int(col: str = "fingerprint"):
    """First 15 hex digits (60 bits) of an MD5 as an exact decimal."""
    return F.conv(F.substring(F.col(col), 1, 15), 16, 10).cast("decimal(38,0)")


def dataset_fingerprint(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row (rows, digest); rows = 0 marks an empty dataset."""
    fp = with_row_fingerprint(df, cols, "_fp")
    return fp.agg(F.count(F.lit(1)).alias("rows"),
                  F.coalesce(F.sum(fingerprint_int("_fp")), F.lit(0).cast("decimal(38,0)"))
                  .cast("string").alias("digest"))


def unseen(df: DataFrame, ledger: DataFrame, cols: list[str] | None = None, ledger_col: str = "fingerprint") -> DataFrame:
    """D3: rows whose fingerprint is not yet in the ledger (left-anti join)."""
    fp = with_row_fingerprint(df, cols)
    seen = ledger.select(F.col(ledger_col).alias("_seen")).where(F.col("_seen").isNotNull())
    return fp.join(seen, fp.fingerprint == seen._seen, "left_anti")
