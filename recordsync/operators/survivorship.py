"""Which source a field's value comes from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Documents that one task expands to candidates (about).
TASK_ROWS = 200_000


def dealt_evenly(df: DataFrame, rows: int, *keys: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """``df`` (of up to ``rows`` rows) by the hash of ``keys``, which together are rarely one, in tasks of ``task_rows``: what
    is expanded and sorted for an aggregate then doesn't grow with the splits of the files, and Spark, which would go by the
    bytes of texts not yet expanded, puts no partitions together."""
    return df.repartition(max(1, -(-rows // task_rows)), *keys)


def candidates(df: DataFrame, key: str, source: str, fields: dict[str, Column], order: Column | None = None,
               present: dict[str, Column] | None = None) -> DataFrame:
    """(key, field, value, source, order) of one source: the fields that it has (not null, or ``present``)."""
    listed = F.array(*[F.struct(F.lit(f).alias("field"), v.cast("string").alias("value"),
                                (present[f] if present else v.isNotNull()).alias("there")) for f, v in fields.items()])
    at = F.lit(None).cast("timestamp") if order is None else order
    rows = df.select(F.col(key).alias("key"), at.alias("order"), F.explode(listed).alias("c")).where("c.there")
    return rows.select("key", F.col("c.field").alias("field"), F.col("c.value").alias("value"), F.lit(source).alias("source"), "order")


def survivors(found: DataFrame, precedence: list[str]) -> DataFrame:
    """(key, field, value, source): per key and field the value of the first source of ``precedence`` that has it, of one
    source's values the one latest by ``order`` (then the greatest).  One aggregate that is partial before the shuffle, so
    a key with a third of the values costs a row per task and field."""
    rank = F.array_position(F.array(*[F.lit(s) for s in precedence]), F.col("source"))
    best = found.where(rank > 0).groupBy("key", "field").agg(
        F.max_by(F.struct("value", "source"), F.struct(-rank, "order", "value")).alias("best"))
    return best.select("key", "field", "best.value", "best.source")


def set_address(updated: DataFrame, touched: DataFrame, export: DataFrame, key: str = "id") -> DataFrame:
    """M2: leads that a document was applied to also take street, number (0 if it is none) and district as the CRM has
    them now; ``touched`` (key) and ``export`` (key, street, number, district)."""
    from ..functions.text import house_number
    now = export.select(F.col(key).alias("_ak"), F.col("street").alias("_as"), house_number("number").alias("_an"),
                        F.col("district").alias("_ad")).join(touched.select(F.col(key).alias("_ak")).distinct(), "_ak", "left_semi")
    sets = {"address_street": "_as", "address_number": "_an", "address_district": "_ad"}
    j = updated.join(now, updated[key] == F.col("_ak"), "left")
    return j.select(*[F.when(F.col("_ak").isNotNull(), F.col(sets[c])).otherwise(F.col(c)).cast(updated.schema[c].dataType).alias(c)
                      if c in sets else F.col(c) for c in updated.columns])
