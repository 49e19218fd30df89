"""Keys that hold much of a table, found by a counting sketch, and their rows apart from the others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot that holds more rows than this many even shares of a partition.
HOT_SHARES = 2.0
#: Keys that the sketch counts (it holds as many counters; a key with 1/4000 of the rows can't be missed).
TRACKED = 10_000


def hot_keys(df: DataFrame, key: str, partitions: int, shares: float = HOT_SHARES) -> list:
    """The keys with more than ``shares / partitions`` of the rows: at most ``partitions / shares`` of them.

    One pass with a sketch per task, no shuffle by key; then the exact counts of the few keys that it names."""
    most = max(1, min(int(partitions / shares), TRACKED // 4))
    one = df.select(F.col(key).alias("k"))
    top = one.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(k, {most}, {TRACKED})").alias("top")).first()
    least = shares * top.n / partitions
    found = [t["item"] for t in top.top or [] if t["count"] > least]  # the sketch counts nothing too low by more than it tells
    if not found:
        return []
    counted = split_hot(one, "k", found)[0].groupBy("k").count()
    return [r.k for r in counted.where(F.col("count") > least).collect()]


def split_hot(df: DataFrame, key: str, hot: list) -> tuple[DataFrame, DataFrame]:
    """The rows of the hot keys, and the others."""
    named = [k for k in hot if k is not None]
    is_hot = F.col(key).isin(named) if named else F.lit(False)
    is_hot = F.coalesce(is_hot, F.lit(None in hot))
    return df.where(is_hot), df.where(~is_hot)

