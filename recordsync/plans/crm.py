"""CRM-side building blocks shared by several queries and jobs.

custom-field table (J9), normalised staging of the CRM export (L3), the
validated export (Q-1), ERP match by tax id (M9-M14) and the CRM's allowed
sales-rep options (N7/J12).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as X
from ..operators import joins as J
from ..operators import quality as Q
from ..schemas import (CF_CLIENT_CODE, CF_FINANCIAL_ANALYSIS, CF_SALES_REP, CF_TAX_REGISTRATION, DIFF_FIELDS,
                       STAGES_ALIAS, STAGES_CANONICAL, SYNCED_STAGES)
from ..sources.standins import DomainTables
from . import views as V

# Exclusion list of the daily reconciliation (lead ids / company names).
EXCLUDED_LEAD_IDS = [12345678]
EXCLUDED_COMPANIES = ["Customer#000000007"]

ALIAS_TO_CANON = dict(zip(STAGES_ALIAS, STAGES_CANONICAL))
CANON_TO_ALIAS = dict(zip(STAGES_CANONICAL, STAGES_ALIAS))


def canon_to_alias(c):
    m = F.create_map(*[x for a, b in CANON_TO_ALIAS.items() for x in (F.lit(a), F.lit(b))])
    return F.try_element_at(m, X.nbsp_to_space(c))


def custom_field_table(t: DomainTables) -> DataFrame:
    """Per lead, the last value of each custom field (one aggregate)."""
    r = t.custom_field_rows

    def last(fid):
        hit = F.col("id") == fid
        return F.max_by(F.when(hit, F.col("value")), F.when(hit, F.col("pos")))
    return r.groupBy(F.col("leadId").alias("lead_id")).agg(
        last(CF_SALES_REP).alias("sales_rep"), last(CF_TAX_REGISTRATION).alias("tax_registration"),
        last(CF_FINANCIAL_ANALYSIS).alias("financial_analysis"), last(CF_CLIENT_CODE).alias("client_code"))


def validated_export(t: DomainTables) -> DataFrame:
    e = t.crm_export.withColumn("stage", X.nbsp_to_space(F.col("stage")))
    cf = custom_field_table(t)
    e = e.join(cf.select("lead_id", "sales_rep"), e.id == F.col("lead_id"), "left").drop("lead_id")
    return Q.validate_leads(e, F.col("sales_rep"))


def staged_leads(t: DomainTables) -> DataFrame:
    """L3 staging: CRM export rows in the synced stages, minus the excluded
    id, normalised to the lead schema and enriched with custom fields."""
    e = t.crm_export.withColumn("stage", canon_to_alias(F.col("stage")))
    e = e.where(F.col("stage").isin(*SYNCED_STAGES))
    ids = t.spark.createDataFrame([(i,) for i in EXCLUDED_LEAD_IDS], "x bigint")
    e = J.exclude(e, "id", ids, "x")
    cf = custom_field_table(t)
    j = e.join(cf, e.id == cf.lead_id, "left")
    return j.select(
        "id", F.col("lead").alias("name"), "stage", F.col("cnpj").alias("taxid"),
        F.col("industry.value").alias("industry"), F.col("source.value").alias("source"),
        X.strip_punct(F.col("phone1")).alias("phone"), F.col("street").alias("address_street"),
        X.strip_punct(F.col("cep")).alias("address_zipcode"),
        X.house_number(F.col("number")).alias("address_number"), F.col("complement").alias("address_complement"),
        F.col("district").alias("address_district"), "city", "state",
        F.col("sales_rep").try_cast("bigint").alias("sales_rep"),
        X.registration_to_erp(F.col("tax_registration")).alias("tax_registration"),
        "financial_analysis")


def matched_changes(t: DomainTables) -> DataFrame:
    """Valid staged leads joined to their ERP client row by tax id key."""
    s = staged_leads(t)
    cv = V.client_base(t).join(V.min_industry(t), V.KEYS, "left")
    cv = cv.select(*[F.col(c).alias(f"erp_{c}") for c in cv.columns])
    return J.taxid_join(s, "taxid", cv, "erp_taxid")


def rep_options(t: DomainTables) -> DataFrame:
    """The CRM's allowed sales-rep codes (options of the custom field)."""
    d = t.lead_docs.select(F.explode("CustomFields").alias("f")).where(F.col("f.id") == CF_SALES_REP)
    return d.select(F.col("f.value").cast("bigint").alias("code")).distinct()
