"""Outbound payload tables.

A payload is a nested struct built with ``struct``/``array`` and serialised
with ``to_json`` (NULL fields are omitted, N10); numbers the CRM expects as
text are cast to string (F27).  Delivery is left to a sink
(``foreachBatch``/``foreachPartition`` with a caller-supplied client, or an
outbound table); no HTTP happens here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nested import _c
from ..functions.text import int_part, strip_punct, zfill
from ..schemas import (BUDGET_PRODUCT_ID, CF_CLIENT_CODE, CF_FINANCIAL_ANALYSIS, CF_SALES_REP, CF_TAX_REGISTRATION,
                       OBSERVATION_TEXT, PAYLOAD_COUNTRY, QUALIFICATION_QA, QUALIFICATION_QUESTION_TYPE,
                       SALE_REP_EMAIL)


def _s(c) -> Column:
    return _c(c).cast("string")


def _cf_value(fid: str, value: Column) -> Column:
    return F.struct(F.lit(fid).alias("id"), value.alias("value"),
                    F.lit(None).cast("array<struct<value:string>>").alias("options"))


def _cf_option(fid: str, value: Column) -> Column:
    return F.struct(F.lit(fid).alias("id"), F.lit(None).cast("string").alias("value"),
                    F.array(F.struct(value.alias("value"))).alias("options"))


def insert_payload(cands: DataFrame, rep_col: str = "sales_rep_checked") -> DataFrame:
    """B1: create-lead body for each insert candidate (numbers as text, tax
    id zero-filled, registration without '.'/'-' and 'ISENTO' -> '99')."""
    stripped = strip_punct(F.col("tax_registration"))
    reg = F.when(stripped == "ISENTO", F.lit("99")).otherwise(stripped)
    lead = F.struct(
        F.col("name").alias("name"), F.col("industry").alias("industry"), F.col("address").alias("address"),
        _s("zipcode").alias("zipcode"), _s("phone").alias("phone"), _s("number").alias("addressNumber"),
        F.col("complement").alias("addressComplement"), F.col("district").alias("neighborhood"),
        F.col("city").alias("city"), F.col("state").alias("state"), zfill(F.col("taxid")).alias("cpfcnpj"),
        F.lit(PAYLOAD_COUNTRY).alias("country"),
        F.array(_cf_option(CF_SALES_REP, _s(rep_col)), _cf_value(CF_CLIENT_CODE, _s("client_code")),
                _cf_value(CF_TAX_REGISTRATION, reg)).alias("customFields"))
    body = F.struct(F.lit("true").alias("duplicityValidation"), lead.alias("lead"))
    return cands.select("client_code", F.to_json(body).alias("payload"))


def update_payload(diff: DataFrame, rep_col: str = "sales_rep_checked") -> DataFrame:
    """B2: update-lead body for each changed lead (missing number -> 'SN',
    missing complement -> '', missing analysis -> 'Vazio.')."""
    reg = F.trim(_s("tax_registration"))
    lead = F.struct(
        F.col("name").alias("name"), F.col("address_street").alias("address"),
        int_part(F.col("address_zipcode")).alias("zipcode"),
        F.coalesce(int_part(F.col("address_number")), F.lit("SN")).alias("addressNumber"),
        F.coalesce(F.col("address_complement"), F.lit("")).alias("addressComplement"),
        F.col("address_district").alias("neighborhood"), F.col("city").alias("city"), F.col("state").alias("state"),
        zfill(int_part(F.col("taxid"))).alias("cpfcnpj"), F.lit(PAYLOAD_COUNTRY).alias("country"),
        F.array(_cf_option(CF_SALES_REP, _s(rep_col)), _cf_value(CF_CLIENT_CODE, _s("client_code")),
                _cf_value(CF_TAX_REGISTRATION, F.when(reg == "ISENTO", F.lit("99")).otherwise(reg)),
                _cf_value(CF_FINANCIAL_ANALYSIS, F.coalesce(F.col("financial_analysis"), F.lit("Vazio."))))
        .alias("customFields"))
    body = F.struct(F.lit("true").alias("duplicityValidation"), lead.alias("lead"))
    return diff.select("id", F.to_json(body).alias("payload"))


def contact_payload(diff: DataFrame) -> DataFrame:
    """Update-contact body; rows without a lead id are skipped."""
    p = F.upper(F.col("is_primary"))
    body = F.struct(F.col("lead_id").alias("leadId"), F.col("name").alias("name"),
                    F.lower(F.col("email")).alias("email"),
                    F.coalesce(int_part(F.col("phone")), F.lit("5500000000")).alias("phone1"),
                    F.col("job_title").alias("jobTitle"),
                    F.when(p == "S", F.lit(True)).when(p == "N", F.lit(False)).alias("mainContact"))
    return diff.where(F.col("lead_id").isNotNull()).select("id", F.to_json(body).alias("payload"))


def _product(value: Column) -> Column:
    # Money goes out as a plain decimal (a double would print as 1.2E7).
    return F.array(F.struct(F.lit(BUDGET_PRODUCT_ID).alias("productId"), F.lit(1).alias("quantity"),
                            value.cast("decimal(38,6)").alias("labelValue")))


def budget_payload(df: DataFrame, value_col: str = "budget_value") -> DataFrame:
    """Budget body (product 10001, quantity 1, value)."""
    body = F.struct(F.col("id").alias("leadId"), _product(F.col(value_col)).alias("products"))
    return df.select("id", F.to_json(body).alias("payload"))


def sale_payload(df: DataFrame, value_col: str = "order_value") -> DataFrame:
    """Sale body (fixed sales-rep e-mail as the source sends it)."""
    body = F.struct(F.col("id").alias("leadId"), F.lit(SALE_REP_EMAIL).alias("salesRepEmail"),
                    F.lit(False).alias("ignoreSalesRep"), _product(F.col(value_col)).alias("products"))
    return df.select("id", F.to_json(body).alias("payload"))


def qualification_rows(leads: DataFrame, key: str) -> DataFrame:
    """Three qualification bodies per lead; the constant question
    list is an inline array exploded per row (no join at all)."""
    qa = F.array(*[F.struct(F.lit(q).alias("questionId"), F.lit(a).alias("answerId")) for q, a in QUALIFICATION_QA])
    x = leads.select(key, F.explode(qa).alias("qa"))
    body = F.struct(F.col(key).alias("leadId"), F.array(F.struct(
        F.col("qa.questionId").alias("questionId"), F.lit(QUALIFICATION_QUESTION_TYPE).alias("questionType"),
        F.array(F.col("qa.answerId")).alias("answersIds"))).alias("answersList"))
    return x.select(key, F.col("qa.questionId").alias("question_id"), F.to_json(body).alias("payload"))


def contact_insert_payload(contacts: DataFrame) -> DataFrame:
    """Create-contact body per contact (id, name, email, phone, job_title, is_primary 'S'/'N') of a lead (lead_id)."""
    body = F.struct(F.col("name"), F.col("email"), _s("phone").alias("phone1"), F.col("job_title").alias("jobTitle"),
                    (F.upper("is_primary") == "S").alias("mainContact"), _s("lead_id").alias("leadId"))
    return contacts.select("lead_id", F.col("id").alias("contact_id"), F.to_json(body).alias("payload"))


def observation_payload(df: DataFrame, flag_col: str) -> DataFrame:
    """Observation text by flag: 'N' -> nested under lead, 'S' -> top level."""
    f = F.col(flag_col)
    body = (F.when(f == "N", F.to_json(F.struct(F.struct(F.lit(OBSERVATION_TEXT["N"]).alias("description"))
                                                  .alias("lead"))))
            .when(f == "S", F.to_json(F.struct(F.lit(OBSERVATION_TEXT["S"]).alias("description")))))
    return df.select("*", body.alias("payload"))


def clean_digits(c) -> Column:
    """keep digits only (phones)."""
    return F.regexp_replace(strip_punct(c), r"[^0-9]", "")
