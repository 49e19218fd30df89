"""Document-level helpers: selection, parse errors, batch names, outcomes
(P10, Q-5, Q-7, F13, F28, B9, B10, M22)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import slug
from ..schemas import CF_CLIENT_CODE
from .merge import merge_snapshot


def docs_for_leads(docs: DataFrame, lead_ids: DataFrame, id_col: str = "id", file_contains: str | None = "converted",
                   file_col: str = "source_file") -> DataFrame:
    """P10: documents of the given leads, guarding the shape (``Lead`` must
    be an object with an ``Id``); one semi join instead of a directory scan
    per lead id."""
    d = docs.where(F.col("Lead").isNotNull() & F.col("Lead.Id").isNotNull())
    if file_contains:
        d = d.where(F.col(file_col).contains(file_contains))
    ids = lead_ids.select(F.col(id_col).alias("_lid")).distinct()
    return d.join(ids, F.col("Lead.Id") == F.col("_lid"), "left_semi")


def corrupt_split(docs: DataFrame, corrupt_col: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """Q-5/Q15: parsed documents and unparsable ones (kept with their text,
    never silently dropped)."""
    bad = docs.where(F.col(corrupt_col).isNotNull())
    return docs.where(F.col(corrupt_col).isNull()).drop(corrupt_col), bad


def batch_name(kind: str, key: Column, batch_id: Column | None = None, at: Column | None = None) -> Column:
    """Queue file name ``kind_<slug(key)>_<batch time>_<id>``.

    A batch id (e.g. the micro-batch epoch or a row fingerprint) is always
    part of the name, so two documents of the same second never overwrite
    each other."""
    ts = F.date_format(F.current_timestamp() if at is None else at, "yyyy_MM_dd_HH_mm_ss")
    parts = [F.lit(kind), slug(key), ts] + ([batch_id.cast("string")] if batch_id is not None else [])
    return F.concat_ws("_", *parts)


def classify_outcome(status: Column, message: Column) -> Column:
    """Q-7: a duplicated client-code error from the CRM counts as success."""
    dup = message.contains("Duplicated Keys") & message.contains(CF_CLIENT_CODE)
    return (F.when(status.between(200, 299), F.lit("ok")).when(dup, F.lit("ok_duplicate_client_code"))
            .otherwise(F.lit("error")))


def client_code_payload(df: DataFrame, lead_col: str = "id_crm", code_col: str = "client") -> DataFrame:
    """Client-code write-back body for each (lead, new client code)."""
    body = F.struct(F.col(lead_col).alias("Id"), F.array(F.struct(
        F.lit(CF_CLIENT_CODE).alias("field_name"), F.col(code_col).cast("string").alias("field_value")))
        .alias("Fields"))
    return df.select(F.col(lead_col).alias("lead_id"), F.to_json(body).alias("payload"))


def placeholder_contact_payload(leads: DataFrame, lead_col: str = "id", name: str = "Dummy contact") -> DataFrame:
    """Placeholder contact body for a lead."""
    return leads.select(F.col(lead_col).alias("lead_id"),
                        F.to_json(F.struct(F.lit(name).alias("name"), F.col(lead_col).alias("leadId")))
                        .alias("payload"))


def load_industries(target: DataFrame, incoming: DataFrame, key: str = "industry") -> DataFrame:
    """Industry list load as an upsert on the industry code."""
    return merge_snapshot(target, incoming.dropDuplicates([key]), [key])
