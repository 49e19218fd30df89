"""Field-level change detection (D4) and small change aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def field_diff(source: DataFrame, target: DataFrame, key: str, cols: list[str], null_safe: bool = False) -> DataFrame:
    """Source rows missing in the target or with any changed column,
    plus ``tgt_id`` and the comma-separated list of changed columns.

    ``!=`` with a NULL side is not a change unless ``null_safe`` (Q9).  One
    left join on the key; the comparison is a generated OR of per-column
    predicates evaluated in the same codegen stage.
    """
    tg = target.select(F.col(key).alias("tgt_id"), *[F.col(c).alias(f"_t_{c}") for c in cols])
    j = source.join(tg, F.col(key) == F.col("tgt_id"), "left")

    def changed(c):
        s, tc = F.col(c), F.col(f"_t_{c}")
        return ~s.eqNullSafe(tc) if null_safe else F.coalesce(s != tc, F.lit(False))
    cond = F.col("tgt_id").isNull()
    for c in cols:
        cond = cond | changed(c)
    diff = F.filter(F.array(*[F.when(changed(c), F.lit(c)) for c in cols]), lambda x: x.isNotNull())
    return j.where(cond).select(*source.columns, "tgt_id", F.array_join(diff, ",").alias("changed"))


def product_total(sold: DataFrame, key: str = "lead_id", value: str = "final_value") -> DataFrame:
    """Σ product values per lead, a missing value counting as 0."""
    return sold.groupBy(key).agg(F.coalesce(F.sum(F.coalesce(value, F.lit(0))), F.lit(0)).cast("double").alias("total"))
