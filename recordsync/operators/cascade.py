"""Client cascade (M9-M14, M16): what a CRM lead change does to the ERP.

The source runs a row trigger that calls a procedure per lead.  Here the
whole change set is processed at once: changes are matched to ERP clients by
tax-id key (one equi-join), matched ones produce branch updates, unmatched
ones become new clients with generated codes, and each target table gets its
own change DataFrame derived from one frame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_key, strip_punct, taxid_key, taxid_too_long
from ..schemas import DEFAULTS, NEW_CLIENT_REGISTRATION
from ..session import cut_lineage
from .joins import first_per_key
from .merge import resolve_city
from .quality import assign_ids


def _ne(a: Column, b: Column) -> Column:
    """Oracle ``<>``: a NULL side is never a change (Q9)."""
    return F.coalesce(a != b, F.lit(False))


def format_registration(reg: Column, state: Column) -> Column:
    """registration formatting by state.  The source's body is not
    available, so only punctuation is removed (documented gap)."""
    return strip_punct(F.coalesce(reg, F.lit(NEW_CLIENT_REGISTRATION)))


def branch_update(matched: DataFrame, cities: DataFrame, states: DataFrame) -> DataFrame:
    """Per matched (lead, ERP branch) the new branch values.

    ``matched`` holds the staged lead columns and the ERP view columns
    prefixed ``erp_``.  Address/name change -> registration re-formatted;
    rep or phone change -> both set; not yet linked -> link to the CRM id.
    City changes compare resolved city codes (Q8).
    """
    m = resolve_city(matched, "city", "state", cities, states)
    u = F.upper
    addr = (_ne(u("erp_company_name"), u("name")) | _ne(u("erp_address_street"), u("address_street"))
            | _ne(F.col("erp_address_number"), F.col("address_number"))
            | _ne(u("erp_address_complement"), u("address_complement"))
            | _ne(u("erp_address_district"), u("address_district"))
            | _ne(F.col("erp_city_code"), F.col("city_code"))
            | _ne(F.col("erp_address_zipcode"), F.col("address_zipcode")))
    rep = _ne(F.col("erp_sales_rep"), F.col("sales_rep")) | _ne(F.col("erp_phone"), F.col("phone"))
    ind = _ne(normalize_key(F.col("erp_industry")), normalize_key(F.col("industry")))
    link = (F.col("erp_integrate_crm") == "N") | F.col("erp_id_crm").isNull()
    state = F.coalesce(F.col("state_code").cast("string"), F.lit(DEFAULTS["state"]))
    return m.select(
        F.col("erp_client_code").alias("client"), F.col("erp_branch_code").alias("code"), F.col("id").alias("lead_id"),
        F.when(addr, format_registration(F.col("tax_registration"), state)).otherwise(F.col("erp_tax_registration"))
         .alias("tax_registration"),
        F.when(rep, F.col("sales_rep")).otherwise(F.col("erp_sales_rep")).alias("sales_rep"),
        F.when(rep, F.col("phone")).otherwise(F.col("erp_phone")).alias("phone"),
        F.when(link, F.col("id")).otherwise(F.col("erp_id_crm")).alias("id_crm"),
        F.lit("Y").alias("integrate_crm"),
        addr.alias("address_changed"), rep.alias("rep_changed"), ind.alias("industry_changed"))


def industry_change(matched: DataFrame, industries: DataFrame) -> DataFrame:
    """The industry that a client-branch gets where its lead names another one than the ERP shows: the least code
    of that name, else the default; of several leads of a branch the one with the greatest CRM id."""
    code = industries.groupBy(normalize_key(F.col("description")).alias("_ki")).agg(F.min("industry").alias("_code"))
    name = normalize_key(F.col("industry"))
    changed = matched.where(_ne(normalize_key(F.col("erp_industry")), name)).join(code, name == F.col("_ki"), "left")
    new = F.coalesce(F.col("_code"), F.lit(DEFAULTS["industry"]).cast("bigint"))
    return changed.groupBy(F.col("erp_client_code").alias("client"), F.col("erp_branch_code").alias("branch")).agg(
        F.max_by(new, F.col("id")).alias("industry"))


def rejected_leads(changes: DataFrame) -> DataFrame:
    """Leads whose tax id is longer than the ERP's 14 characters: the source cuts it and so hits another client; here
    they act on nothing and are kept with the reason (one row per lead)."""
    return changes.where(taxid_too_long("taxid")).select("id", "taxid", F.lit("taxid_too_long").alias("reason"))


def new_clients(changes: DataFrame, branches: DataFrame, cities: DataFrame, states: DataFrame,
                industries: DataFrame | None = None, claim: Callable[[int], int] | None = None) -> dict[str, DataFrame]:
    """M9: leads whose tax id has no ERP branch become new clients.

    One lead per tax id (lowest CRM id), codes ``max(client) + rank`` by tax
    id (no single-task window), then the rows for clients, branches, the
    rep link, the billing address, the industry and the credit history are
    projections of the same frame.  Leads without a usable tax id are no
    clients (see ``rejected_leads``).  ``claim`` reserves so many codes and
    gives the one before the first (for micro-batches, see ``IdLedger``).
    """
    known = branches.select(taxid_key(F.col("taxid")).alias("_tk")).where(F.col("_tk").isNotNull())
    c = changes.withColumn("_tk", taxid_key(F.col("taxid"))).where(F.col("_tk").isNotNull())
    c = c.join(known, "_tk", "left_anti")
    c = first_per_key(c, ["_tk"], ["id"])
    c = resolve_city(c, "city", "state", cities, states)
    if claim:
        c = cut_lineage(c)
        start = claim(c.count())
    else:
        start = branches.agg(F.coalesce(F.max("client"), F.lit(0)).cast("bigint")).scalar()
    c = assign_ids(c, start, ["_tk"], "client")
    state = F.coalesce(F.col("state_code").cast("string"), F.lit(DEFAULTS["state"]))
    u = F.upper
    base = c.select(
        "client", F.lit(1).cast("bigint").alias("code"), u("name").alias("description"),
        F.coalesce(u("address_street"), F.lit(DEFAULTS["address_street"])).alias("address"),
        F.coalesce(u("address_district"), F.lit(DEFAULTS["address_street"])).alias("district"),
        F.col("address_zipcode").alias("zipcode"),
        F.coalesce(F.col("city_code"), F.lit(DEFAULTS["city"]).cast("bigint")).alias("city"),
        state.alias("state"),
        F.coalesce(F.col("country_code"), F.lit(DEFAULTS["country"])).alias("country"),
        F.coalesce(F.col("sales_rep"), F.lit(DEFAULTS["sales_rep"]).cast("bigint")).alias("sales_rep"),
        F.col("phone"), F.col("_tk").alias("taxid"),
        format_registration(F.col("tax_registration"), state).alias("tax_registration"),
        F.col("address_number").alias("number"), F.col("address_complement").alias("complement"),
        F.col("id").alias("id_crm"), F.lit(True).alias("integrate_crm"),
        F.col("financial_analysis"), F.col("industry"), F.col("address_street").alias("_street"),
        F.col("address_district").alias("_district"), F.col("sales_rep").alias("_rep"))
    out = {
        "branches": base.drop("financial_analysis", "industry", "_street", "_district", "_rep"),
        "clients": base.select(F.col("client").alias("client_code"), F.col("description").alias("company_name"),
                               "address", "district", "city", F.col("state").alias("state_code"), "zipcode",
                               "country", "number", "complement"),
        "sales_rep_branches": base.select(F.col("client").alias("client_code"), F.col("code").alias("branch_code"),
                                          F.col("_rep").alias("sales_rep_code"),
                                          F.col("client").alias("from_to_client"),
                                          F.col("code").alias("from_to_branch")),
        "billing_addresses": base.select(F.col("client").alias("client_code"), F.col("code").alias("branch_code"),
                                         F.col("_street").alias("billing_address"),
                                         F.col("zipcode").alias("billing_zipcode"), F.col("city").alias("city_code"),
                                         F.col("state").alias("state_code"), F.col("country").alias("country_code"),
                                         F.upper("_district").alias("billing_district"),
                                         F.col("phone").alias("billing_phone"), "complement", "number"),
        "credit_limit_history": base.where(F.col("financial_analysis").isNotNull()).select(
            F.col("client").alias("client_code"), F.lit(1).cast("bigint").alias("sequence"),
            F.col("financial_analysis").alias("observations")),
    }
    if industries is not None:
        ind = industries.groupBy(normalize_key(F.col("description")).alias("_ki")).agg(F.min("industry").alias("_code"))
        out["client_industries"] = (base.join(ind, normalize_key(F.col("industry")) == F.col("_ki"))
                                    .select(F.col("client"), F.col("code").alias("branch"),
                                            F.col("_code").alias("industry"), F.lit("A").alias("status")))
    return out


def client_cascade(changes: DataFrame, client_view: DataFrame, branches: DataFrame, cities: DataFrame,
                   states: DataFrame, history: DataFrame, industries: DataFrame | None = None,
                   initial_load: bool = False, claim: Callable[[int], int] | None = None) -> dict[str, DataFrame]:
    """Everything a batch of CRM lead changes does to the ERP.

    ``changes`` are staged leads (lead schema), ``client_view`` the ERP
    client view with ``industry``.  Initial load only links branches to
    their CRM id by tax id; otherwise matched leads update their branch
    (and append a credit-history row when an analysis is given) and
    unmatched ones become new clients.  Returns one change DataFrame per
    target table; each is derived from the same matched frame.
    """
    from .merge import next_sequence, write_back
    from .joins import taxid_join
    if initial_load:
        pairs = changes.select(taxid_key(F.col("taxid")).alias("taxid"), F.col("id").alias("id_crm"))
        linked = write_back(branches, pairs, taxid_key(F.col("taxid")), "taxid",
                            {"id_crm": F.col("_p_id_crm"), "integrate_crm": F.lit(True)})
        return {"branches": linked}
    cv = client_view.select(*[F.col(c).alias(f"erp_{c}") for c in client_view.columns])
    matched = taxid_join(changes, "taxid", cv, "erp_taxid")
    if claim:  # a micro-batch: small, and three tables come from it
        matched = cut_lineage(matched)
    out = {"branch_updates": branch_update(matched, cities, states)}
    hist_rows = matched.where(F.col("financial_analysis").isNotNull()).select(
        F.col("erp_client_code").alias("client_code"), F.col("financial_analysis").alias("observations"),
        F.col("id").alias("lead_id"))
    out["credit_limit_history"] = next_sequence(history, hist_rows, "client_code", "sequence", "lead_id")
    if industries is not None:
        out["client_industries"] = industry_change(matched, industries)
    new = new_clients(changes, branches, cities, states, industries, claim)
    out.update({f"new_{k}": v for k, v in new.items()})
    out["rejects"] = rejected_leads(changes)
    return out
