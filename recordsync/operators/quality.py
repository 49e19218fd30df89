"""Validation, quarantine and error logs (Q-1..Q-7, S15, S17).

Per-record failures never abort a run: each record gets the list of its
failed checks; valid and rejected rows are two filters of the same persisted
frame, and rejects keep a reason.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CONTACT_REQUIRED, LEAD_REQUIRED, SYNCED_STAGES


def falsy(c: Column, dtype: T.DataType) -> Column:
    """Python truthiness of a typed value: NULL, '' and 0 are missing."""
    if isinstance(dtype, T.StringType):
        return c.isNull() | (c == "")
    if isinstance(dtype, T.NumericType):
        return c.isNull() | (c == 0)
    if isinstance(dtype, T.BooleanType):
        return c.isNull() | ~c
    return c.isNull()


def _dtype(df: DataFrame, path: str) -> T.DataType:
    t: T.DataType = df.schema
    for p in path.split("."):
        t = t[p].dataType  # type: ignore[index]
    return t


def validate(df: DataFrame, required: list[str], applies: Column | None = None, extra: dict | None = None,
             out: str = "failed_fields") -> DataFrame:
    """Q-1/Q-2: add ``failed_fields`` (check order kept) for rows the checks
    apply to; other rows pass.  ``extra`` maps a field label to an extra
    missing-condition column (e.g. the sales rep custom field)."""
    checks = [(label, cond) for label, cond in (extra or {}).items()]
    checks += [(f, falsy(F.col(f), _dtype(df, f))) for f in required]
    arr = F.filter(F.array(*[F.when(cond, F.lit(label)) for label, cond in checks]), lambda x: x.isNotNull())
    if applies is not None:
        arr = F.when(applies, arr).otherwise(F.array().cast("array<string>"))
    return df.withColumn(out, arr)


def validate_leads(export: DataFrame, sales_rep: Column | None = None, initial_load: bool = False) -> DataFrame:
    """Q-1: CRM leads in the synced stages need 11 fields; during an initial
    load the sales rep is required too (the regular full sync runs with the
    initial-load flag off, so a missing rep does not reject a lead there)."""
    from ..schemas import STAGES_ALIAS, STAGES_CANONICAL
    synced_canon = [STAGES_CANONICAL[STAGES_ALIAS.index(s)] for s in SYNCED_STAGES]
    extra = ({"REPRESENTANTE": falsy(sales_rep, T.StringType())}
             if sales_rep is not None and initial_load else None)
    return validate(export, LEAD_REQUIRED, applies=F.coalesce(F.col("stage").isin(*synced_canon), F.lit(False)),
                    extra=extra)


def missing_field_log(validated: DataFrame, id_col: str = "id", name_col: str = "lead",
                      failed_col: str = "failed_fields", first_only: bool = True) -> DataFrame:
    """Q-3: one log row per rejected record (the first failed check, as the
    source logs it) or per failed field with ``first_only=False``."""
    bad = validated.where(F.size(failed_col) > 0)
    fields = F.slice(F.col(failed_col), 1, 1) if first_only else F.col(failed_col)
    return bad.select(F.col(id_col).cast("string").alias("lead_id"), F.col(name_col).alias("lead_name"),
                      F.explode(fields).alias("field"), F.lit("Campo vazio").alias("value"))


def split_valid(validated: DataFrame, failed_col: str = "failed_fields") -> tuple[DataFrame, DataFrame]:
    """Valid rows and rejects (rejects keep the failed list as reason)."""
    ok = validated.where(F.size(failed_col) == 0).drop(failed_col)
    rej = validated.where(F.size(failed_col) > 0).withColumn("reason", F.array_join(failed_col, ","))
    return ok, rej


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q-6: keys that occur more than once (primary-key check)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).where(F.col("occurrences") > 1)


def assign_ids(df: DataFrame, start: Column | int, order: list[str], out: str = "id") -> DataFrame:
    """Sequence-like ids ``start + 1, start + 2, ...`` in ``order``
    without a single-task global window.

    Rows are range-partitioned and sorted on ``order``; the partition id and
    the position inside it come from ``monotonically_increasing_id`` (upper
    and lower bits).  The numbered frame is checkpointed in the shared folder
    before it is used twice: for the per-partition counts (one row per
    partition, so a bounded broadcast), which give each partition its offset,
    and for the rows.  Both so see the same partitions, also after an
    executor is lost.

    ``order`` should be unique (ties are numbered in arbitrary order).
    """
    from ..session import cut_lineage
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order)
    mid = F.monotonically_increasing_id()
    tagged = cut_lineage(parts.withColumn("_pid", F.shiftright(mid, 33)).withColumn("_pos", (mid % (1 << 33)) + 1))
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))).select("_pid", "_off")
    s = start if isinstance(start, Column) else F.lit(start)
    return (tagged.join(F.broadcast(offs), "_pid")
            .withColumn(out, (s + F.col("_off") + F.col("_pos")).cast("bigint"))
            .drop("_pid", "_pos", "_off"))


def error_log_rows(rejects: DataFrame, existing_log: DataFrame | None, code: int, info: Column,
                   created_by: str = "recordsync", order: list[str] | None = None,
                   claim: Callable[[int], int] | None = None) -> DataFrame:
    """Error-log records for rejects with ids continuing the log's
    sequence (``max(log_id) + n``); the current maximum is a scalar sub-query.
    In micro-batches ``claim`` reserves the ids instead (see ``IdLedger``)."""
    from ..session import cut_lineage
    rows = rejects.select(*(order or []), info.alias("error_info"))
    if claim:
        rows = cut_lineage(rows)
        start = claim(rows.count())
    else:
        start = existing_log.agg(F.coalesce(F.max("log_id"), F.lit(0)).cast("bigint")).scalar()
    ids = assign_ids(rows, start, order or ["error_info"], "log_id")
    return ids.select("log_id", F.current_timestamp().alias("created_on"), F.lit(created_by).alias("created_by"),
                      F.lit(code).cast("bigint").alias("errorcode"), F.lit(None).cast("string").alias("callstack"),
                      F.lit(None).cast("string").alias("errorstack"), F.lit(None).cast("string").alias("backtrace"),
                      "error_info", *(order or []))


def full_reload(export: DataFrame, contacts: DataFrame, lead_projection: list, contact_key: str = "leadId",
                sales_rep=None, initial_load: bool = False) -> dict[str, DataFrame]:
    """Validate the full CRM export, keep the valid leads of the synced
    stages (projected to the lead schema by ``lead_projection``), keep the
    contacts of accepted leads that pass their own checks (semi join, J21),
    and return the rejects of both with reasons.  The caller overwrites the
    tables with a new version (never the path being read)."""
    from ..schemas import STAGES_ALIAS, STAGES_CANONICAL
    synced_canon = [STAGES_CANONICAL[STAGES_ALIAS.index(s)] for s in SYNCED_STAGES]
    v = validate_leads(export.where(F.col("stage").isin(*synced_canon)), sales_rep, initial_load)
    ok, rej = split_valid(v)
    leads = ok.select(*lead_projection)
    cv = validate(contacts, CONTACT_REQUIRED)
    c_ok, c_rej = split_valid(cv)
    accepted = ok.select(F.col("id").alias("_acc"))
    return {"leads": leads,
            "contacts": c_ok.join(accepted, F.col(contact_key) == F.col("_acc"), "left_semi"),
            "lead_rejects": rej, "contact_rejects": c_rej}
