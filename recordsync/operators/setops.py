"""Set operators over normalised row sets.

``subtract`` is EXCEPT DISTINCT: Catalyst rewrites it to a null-safe left-anti
join plus a distinct, so both sides shuffle once on all columns and partial
aggregation removes duplicates before the exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _align(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    if sorted(a.columns) != sorted(b.columns):
        raise ValueError(f"column sets differ: {a.columns} vs {b.columns}")
    return a, b.select(*a.columns)


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` not in ``b`` (NULL equals NULL).

    Same result as ``a.subtract(b)``, planned as one grouped aggregate over
    the tagged union: both sides are shuffled once on all columns, with
    duplicates collapsed map-side, instead of an anti join followed by a
    distinct."""
    a, b = _align(a, b)
    cols = a.columns
    tagged = (a.withColumn("_in_b", F.lit(0))
              .unionByName(b.withColumn("_in_b", F.lit(1))))
    g = tagged.groupBy(*cols).agg(F.max("_in_b").alias("_in_b"))
    return g.where(F.col("_in_b") == 0).select(*cols)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """U4: distinct union by column name."""
    a, b = _align(a, b)
    return a.unionByName(b).distinct()


def chained_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """U1/U2 as the source system evaluates ``A MINUS B UNION B MINUS A``:
    set operators bind left to right, so the result is ``B MINUS A``."""
    return except_distinct(b, a)


def sym_diff(a: DataFrame, b: DataFrame, side_col: str = "side",
             left: str = "a_only", right: str = "b_only") -> DataFrame:
    """Symmetric difference with a side label.

    One grouped aggregate instead of two EXCEPTs: rows of both sides are
    tagged, grouped by all columns (null-safe grouping; duplicates collapse
    in the partial aggregation before the single shuffle), and kept when
    present on exactly one side.
    """
    a, b = _align(a, b)
    cols = a.columns
    tagged = (a.withColumn("_a", F.lit(1)).withColumn("_b", F.lit(0))
              .unionByName(b.withColumn("_a", F.lit(0)).withColumn("_b", F.lit(1))))
    g = tagged.groupBy(*cols).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    return (g.where(F.col("_a") + F.col("_b") == 1)
            .select(*cols, F.when(F.col("_a") == 1, F.lit(left)).otherwise(F.lit(right)).alias(side_col)))
