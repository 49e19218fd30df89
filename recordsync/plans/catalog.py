"""Query catalog: one lazy DataFrame builder per operator key.

Each entry takes (spark, sf_dir) and returns a DataFrame over the whole
driver tables (through the stand-in domain tables); nothing is sampled or
capped except where the limit is the feature itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.standins import DomainTables
from . import views as V

Builder = Callable[[DomainTables], DataFrame]

_REGISTRY: dict[str, Builder] = {}


def register(key: str):
    def deco(fn: Builder) -> Builder:
        _REGISTRY[key] = fn
        return fn
    return deco


_TABLES: dict[tuple[str, str], DomainTables] = {}


def tables(spark: SparkSession, sf_dir: str) -> DomainTables:
    """One set of (lazy) domain DataFrames per session and directory, so the
    stand-in plans are built and analysed once, not once per query."""
    key = (spark.conf.get("spark.app.id"), sf_dir)
    t = _TABLES.get(key)
    if t is None or t.spark is not spark:
        t = _TABLES[key] = DomainTables(spark, sf_dir)
    return t


def use(t: DomainTables) -> None:
    """Let the session's queries over ``t.sf_dir`` read ``t`` (a staged copy, say) from now on."""
    _TABLES[t.spark.conf.get("spark.app.id"), t.sf_dir] = t


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import queries_more  # noqa: F401  (registers the remaining keys)
    return {k: (lambda spark, sf_dir, _f=f: _f(tables(spark, sf_dir))) for k, f in _REGISTRY.items()}


# ---- scans and views ------------------------------------------------------

@register("scan_parquet")
def _scan(t: DomainTables) -> DataFrame:
    li = t.raw("lineitem")
    return li.where(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select(
        "l_orderkey", "l_linenumber", "l_quantity")


register("client_view")(lambda t: V.client_view(t))
register("insert_candidates")(V.insert_candidates)
register("lead_diff")(lambda t: V.lead_diff(t))
register("contact_view")(V.contact_view)
register("contact_diff")(V.contact_diff)
register("budget_value")(lambda t: V.budget_value(t))
register("order_value")(lambda t: V.order_value(t))
register("has_order")(lambda t: V.has_order(t))
register("has_retention")(lambda t: V.order_presence(t))
register("has_budget")(lambda t: V.has_budget(t))
register("has_service_order")(lambda t: V.has_service_order(t))
register("latest_observation")(V.latest_observation)
register("min_industry")(V.min_industry)
@register("min_tier")
def _min_tier(t: DomainTables) -> DataFrame:
    q = V.min_tier(t)
    return q.select("bit_bdg_number", "bit_item", F.col("quantity").cast("double").alias("quantity"))
register("budget_changes")(lambda t: V.budget_changes(t))
register("sold_changes")(lambda t: V.sold_changes(t))


@register("value_override")
def _value_override(t: DomainTables) -> DataFrame:
    from ..schemas import BUDGET_VALUE_OVERRIDES, ORDER_VALUE_OVERRIDES
    b = V.client_base(t).select(*V.KEYS)
    j = b.join(V.budget_value(t), V.KEYS, "left").join(V.order_value(t), V.KEYS, "left")
    return j.select(*V.KEYS,
                    V.with_override(F.col("client_code"), F.col("budget_value"), BUDGET_VALUE_OVERRIDES).alias("budget_value"),
                    V.with_override(F.col("client_code"), F.col("order_value"), ORDER_VALUE_OVERRIDES).alias("order_value"))
