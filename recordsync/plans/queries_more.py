"""Catalog entries for scalar functions, joins, change detection, quality,
merges and payloads.  Each builder runs over whole stand-in tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as X
from ..operators import fingerprint as FP
from ..operators import joins as J
from ..operators import merge as M
from ..operators import quality as Q
from ..operators import setops as S
from ..operators.contacts import CONTACT
from ..operators.payloads import contact_insert_payload
from ..operators.survivorship import TASK_ROWS, candidates, dealt_evenly, set_address, survivors
from ..schemas import (ACTIVATION_STAGE, BUDGET_STAGE, CF_CLIENT_CODE, CF_FINANCIAL_ANALYSIS, CF_SALES_REP,
                       CF_TAX_REGISTRATION, DEFAULTS, LEAD_COLUMNS, LEAD_DIFF_COLS, MAX_LEN, RENAME_MAP,
                       STAGES_CANONICAL, SYNCED_STAGES)
from ..sources.standins import DomainTables
from . import views as V
from .catalog import register
from .crm import (ALIAS_TO_CANON, DIFF_FIELDS, EXCLUDED_COMPANIES, EXCLUDED_LEAD_IDS,  # noqa: F401 (re-exported)
                  canon_to_alias as _canon_to_alias, custom_field_table, matched_changes, rep_options, staged_leads,
                  validated_export)


# ---------------------------------------------------------------------------
# Scalar functions over whole columns
# ---------------------------------------------------------------------------

@register("normalize_text")
def _normalize_text(t: DomainTables) -> DataFrame:
    d = t.raw("documents")
    key = X.normalize_key(F.col("text"))
    return d.select("doc_id", F.md5(key).alias("key_md5"), F.length(key).cast("bigint").alias("key_len"),
                    F.lower(X.remove_accents(F.col("lang"))).alias("lang"))


@register("initcap_words")
def _initcap(t: DomainTables) -> DataFrame:
    p = t.raw("part")
    return p.select("p_partkey", X.initcap_words(F.concat(F.col("p_type"), F.lit("-"), F.col("p_name"))).alias("title"))


@register("client_key")
def _client_key(t: DomainTables) -> DataFrame:
    b = t.branches
    return b.select("client", X.oracle_concat(F.col("client"), F.lit("-"), F.col("code"), F.lit("/"),
                                              F.col("complement")).alias("client_key"))


@register("strip_punct")
def _strip_punct(t: DomainTables) -> DataFrame:
    e = t.crm_export
    return e.select("id", X.strip_punct(F.col("phone1")).alias("phone"), X.strip_punct(F.col("cep")).alias("zipcode"))


@register("slug")
def _slug(t: DomainTables) -> DataFrame:
    p = t.raw("part")
    return p.select("p_partkey", X.slug(F.concat(F.col("p_brand"), F.lit(" / "), F.col("p_type"), F.lit(", "),
                                                 F.col("p_name"), F.lit("."))).alias("slug"))


@register("field_truncate")
def _truncate(t: DomainTables) -> DataFrame:
    p = t.raw("part")
    return p.select("p_partkey", X.truncate(F.col("p_name"), MAX_LEN["name"]).alias("name"),
                    X.truncate(F.col("p_type"), MAX_LEN["phone"]).alias("short"),
                    X.truncate(F.col("p_name"), MAX_LEN["job_title"]).alias("title"))


@register("street_token")
def _street_token(t: DomainTables) -> DataFrame:
    p = t.raw("part")
    addr = F.concat(F.col("p_type"), F.lit(" - "), F.col("p_brand"), F.lit(", "), F.col("p_name"))
    return p.select("p_partkey", X.first_token(F.col("p_name")).alias("first_word"),
                    X.street_token(addr).alias("street"))


@register("int_part")
def _int_part(t: DomainTables) -> DataFrame:
    li = t.raw("lineitem")
    return li.select("l_orderkey", "l_linenumber", X.int_part(F.col("l_quantity")).alias("qty_int"))


@register("house_number")
def _house_number(t: DomainTables) -> DataFrame:
    e = t.crm_export
    return e.select("id", X.house_number(F.col("number")).alias("number"),
                    X.house_number_out(X.house_number(F.col("number")).cast("string")
                                       .try_cast("int").cast("string")).alias("number_out"))


@register("registration_code")
def _registration(t: DomainTables) -> DataFrame:
    d = t.lead_docs
    reg = X.custom_field(F.col("CustomFields"), CF_TAX_REGISTRATION)
    return d.select("id", reg.alias("raw"), X.registration_to_erp(reg).alias("to_erp"),
                    X.registration_to_crm(X.registration_to_erp(reg)).alias("to_crm"))


@register("flag_map")
def _flag_map(t: DomainTables) -> DataFrame:
    c = t.crm_contacts
    return c.select("id", X.flag_to_sn(F.col("mainContact")).alias("is_primary"),
                    X.sn_to_bool(X.flag_to_sn(F.col("mainContact"))).alias("is_primary_bool"))


@register("default_fill")
def _default_fill(t: DomainTables) -> DataFrame:
    l = t.leads
    return l.select(
        "id",
        F.coalesce("address_complement", F.lit(DEFAULTS["address_complement"])).alias("address_complement"),
        F.coalesce("financial_analysis", F.lit(DEFAULTS["financial_analysis"])).alias("financial_analysis"),
        F.coalesce("state", F.lit(DEFAULTS["state"])).alias("state"),
        F.coalesce("phone", F.lit(DEFAULTS["phone"])).alias("phone"))


@register("price_fallback")
def _price_fallback(t: DomainTables) -> DataFrame:
    e = t.budget_item_quant_delivery
    return e.select("bid_bdg_number", "bid_item", F.col("bid_quantity").cast("double").alias("bid_quantity"),
                    "client_code",
                    X.price_fallback(F.col("negotiated_price"), F.col("price")).cast("double").alias("price"))


@register("row_fingerprint")
def _row_fp(t: DomainTables) -> DataFrame:
    b = t.branches
    return FP.with_row_fingerprint(b).select("client", "fingerprint")


# ---------------------------------------------------------------------------
# Filters and joins
# ---------------------------------------------------------------------------

@register("stage_filter")
def _stage_filter(t: DomainTables) -> DataFrame:
    stages = t.spark.createDataFrame([(s,) for s in SYNCED_STAGES], "stage string")  # fixed vocabulary
    return t.leads.join(F.broadcast(stages), "stage", "left_semi").select("id", "stage")


@register("exclusion_anti")
def _exclusion(t: DomainTables) -> DataFrame:
    ids = t.spark.createDataFrame([(i,) for i in EXCLUDED_LEAD_IDS], "x bigint")
    names = t.spark.createDataFrame([(n,) for n in EXCLUDED_COMPANIES], "x string")
    e = J.exclude(t.crm_export, "id", ids, "x")
    return J.exclude(e, "lead", names, "x").select("id", "lead")


@register("rename_map")
def _rename(t: DomainTables) -> DataFrame:
    inv = {v: k for k, v in RENAME_MAP.items()}
    old = t.leads.select("id", *[F.col(c).alias(inv[c]) for c in LEAD_COLUMNS if c in inv])
    out = old.withColumnsRenamed(RENAME_MAP)
    return out.withColumns({c: F.col(c).cast("double") for c in ("budget_value", "order_value")})


@register("semi_restrict")
def _semi(t: DomainTables) -> DataFrame:
    cb = V.client_base(t).where(F.col("id_crm").isNotNull())
    return J.semi_restrict(cb, "id_crm", t.leads, "id").select("id", "client_code", "id_crm")


@register("lead_enrich")
def _lead_enrich(t: DomainTables) -> DataFrame:
    e = t.crm_export.select("id", "lead", "cnpj")
    cf = custom_field_table(t)
    out = J.enrich(e, "id", (cf, "lead_id"))
    return out.select("id", "lead", "cnpj", F.col("sales_rep").cast("bigint").alias("sales_rep"),
                      "tax_registration", "financial_analysis", F.col("client_code").cast("bigint").alias("client_code"))


@register("contact_fanout_join")
def _contact_fanout_join(t: DomainTables) -> DataFrame:
    # New leads are few, a client's contacts may be many: the contacts of
    # one tax id are spread over salt buckets instead of one task.
    new = V.insert_candidates(t).select(F.col("taxid").alias("client_taxid"), "client_code")
    cv = V.contact_view(t)
    j = J.salted_join(cv, new, ["client_taxid"], salt_buckets=8, salt_by=["id"])
    return j.select("client_code", F.col("client_taxid").alias("taxid"), F.col("id").alias("contact_id"), "name",
                    "email", "phone", "job_title", X.sn_to_bool(F.col("is_primary")).alias("is_primary"))


@register("contact_insert_payload")
def _contact_insert_payload(t: DomainTables) -> DataFrame:
    """Create-contact bodies of the clients' contacts for the CRM leads that have their tax id."""
    leads = t.crm_export.select(X.taxid_key("cnpj").alias("_tk"), F.col("id").alias("lead_id")).where(F.col("_tk").isNotNull())
    contacts = V.contact_view(t).withColumn("_tk", X.taxid_key("client_taxid"))
    return contact_insert_payload(J.salted_join(contacts, leads, ["_tk"], salt_buckets=8, salt_by=["id"]))


def with_client(contacts: DataFrame, t: DomainTables) -> DataFrame:
    """The ERP client of a contact, by the tax id of its lead (the lowest client of a tax id)."""
    erp = V.client_base(t).select(X.taxid_key(F.col("taxid")).alias("_ck"), "client_code").where(F.col("_ck").isNotNull())
    erp = J.first_per_key(erp, ["_ck"], ["client_code"])
    return contacts.join(erp, X.taxid_key(F.col("lead_taxid")) == F.col("_ck"), "left").drop("_ck")


@register("contact_client_lookup")
def _contact_client_lookup(t: DomainTables) -> DataFrame:
    j = with_client(t.incoming_contacts.select("id_crm", "lead_id", "lead_taxid"), t)
    return j.select("id_crm", "lead_id", "client_code",
                    F.when(F.col("client_code").isNull(), "quarantine").otherwise("ok").alias("status"))


@register("rep_domain")
def _rep_domain(t: DomainTables) -> DataFrame:
    out = J.domain_or_default(t.leads.select("id", "sales_rep"), "sales_rep", rep_options(t), "code", 99,
                              out="sales_rep_checked")
    return out.select("id", "sales_rep", F.col("sales_rep_checked").cast("bigint").alias("sales_rep_checked"))


@register("city_match")
def _city_match(t: DomainTables) -> DataFrame:
    e = t.crm_export.select("id", "city", "state")
    r = M.resolve_city(e, "city", "state", t.cities, t.states)
    return r.select("id", F.coalesce("city_code", F.lit(DEFAULTS["city"]).cast("bigint")).alias("city_code"),
                    F.coalesce(F.col("state_code").cast("string"), F.lit(DEFAULTS["state"])).alias("state_code"),
                    F.coalesce("country_code", F.lit(DEFAULTS["country"])).alias("country_code"))


@register("industry_match")
def _industry_match(t: DomainTables) -> DataFrame:
    e = t.crm_export.select("id", F.col("industry.value").alias("industry"))
    ind = t.industries.groupBy(X.normalize_key(F.col("description")).alias("_k")).agg(F.min("industry").alias("code"))
    j = e.join(ind, X.normalize_key(F.col("industry")) == F.col("_k"), "left")
    return j.select("id", F.coalesce("code", F.lit(DEFAULTS["industry"]).cast("bigint")).alias("industry_code"))


@register("taxid_match")
def _taxid_match(t: DomainTables) -> DataFrame:
    e = t.crm_export.where(F.col("cnpj").isNotNull()).select("id", "cnpj")
    b = t.branches.select("client", "code", "taxid")
    return J.taxid_join(e, "cnpj", b, "taxid").select("id", "client", "code")


@register("contact_or_match")
def _or_match(t: DomainTables) -> DataFrame:
    return J.or_match(t.incoming_contacts.where(F.col("op") != "D"), t.contact, ("email", "id_crm"),
                      ("email", "id_crm"), "id_crm", "code")


@register("qualification_rows")
def _qualification(t: DomainTables) -> DataFrame:
    from ..operators.payloads import qualification_rows
    return qualification_rows(t.leads.where(F.col("id").isNotNull()).select("id"), "id")


@register("lead_contacts")
def _lead_contacts(t: DomainTables) -> DataFrame:
    l = t.leads.select(F.col("id").alias("lead_id"), F.col("taxid").alias("lead_taxid"))
    c = t.crm_contacts
    return l.join(c, l.lead_id == c.leadId).select("lead_id", "lead_taxid", F.col("id").alias("contact_id"), "name",
                                                    "email")


@register("contact_fanout")
def _contact_fanout(t: DomainTables) -> DataFrame:
    docs = t.webhook_docs.where(F.col("stage").isin(*[ALIAS_TO_CANON[x] for x in SYNCED_STAGES]))
    accepted = t.leads.select("id")
    d = J.semi_restrict(docs, "lead_id", accepted, "id")
    taxid = F.get_json_object("raw", "$.Lead.CpfCnpj").alias("lead_taxid")
    return d.select("doc_id", "lead_id", taxid, F.explode("contacts").alias("c")).select(
        "doc_id", "lead_id", "lead_taxid", F.col("c.Id").alias("contact_id"), F.col("c.Name").alias("contact_name"),
        F.col("c.Email").alias("contact_email"))


@register("first_match")
def _first_match(t: DomainTables) -> DataFrame:
    c = t.contact.select("branch_client", "code", "email")
    return J.first_per_key(c, ["branch_client"], ["code"])


@register("latest_event")
def _latest_event(t: DomainTables) -> DataFrame:
    d = t.webhook_docs.select("lead_id", "doc_id", "received_at", "stage")
    return J.last_per_key(d, ["lead_id"], "received_at", "doc_id")


@register("custom_field_pivot")
def _cf_pivot(t: DomainTables) -> DataFrame:
    d = t.lead_docs
    return d.select("id", *[X.custom_field(F.col("CustomFields"), f).alias(n) for f, n in [
        (CF_SALES_REP, "sales_rep"), (CF_TAX_REGISTRATION, "tax_registration"),
        (CF_FINANCIAL_ANALYSIS, "financial_analysis"), (CF_CLIENT_CODE, "client_code"),
        ("_missing", "missing")]])


@register("key_violations")
def _key_violations(t: DomainTables) -> DataFrame:
    return Q.key_violations(t.sales_order_item, ["so_number", "sequence"])


BATCH = 10


def next_batch(df: DataFrame, key: str, limit: int = BATCH) -> DataFrame:
    """``df`` with ``in_batch``: the ``limit`` smallest keys are sent in this run, the rest remains.
    The batch's keys (``limit`` rows) are broadcast; nothing is dropped."""
    first = df.select(F.col(key).alias("_k")).distinct().orderBy("_k").limit(limit).withColumn("_in", F.lit(True))
    return df.join(F.broadcast(first), F.col(key) == F.col("_k"), "left").select(
        *df.columns, F.coalesce("_in", F.lit(False)).alias("in_batch"))


@register("batch_limit")
def _batch_limit(t: DomainTables) -> DataFrame:
    return next_batch(V.lead_diff(t), "id")


@register("sym_diff")
def _sym_diff(t: DomainTables) -> DataFrame:
    return S.sym_diff(V.crm_lead_rows(t), V.erp_lead_rows(t), left="crm_only", right="erp_only")


@register("dataset_fingerprint")
def _dataset_fp(t: DomainTables) -> DataFrame:
    return FP.dataset_fingerprint(V.lead_diff(t), LEAD_DIFF_COLS)


@register("fingerprint_anti")
def _fp_anti(t: DomainTables) -> DataFrame:
    ledger = FP.with_row_fingerprint(V.crm_lead_rows(t), LEAD_DIFF_COLS)
    return FP.unseen(V.erp_lead_rows(t), ledger, LEAD_DIFF_COLS).select("id", "fingerprint")


@register("product_total")
def _product_total(t: DomainTables) -> DataFrame:
    """Σ product values of each lead's sale as the CRM reports it (the
    first sale), a missing value counting as 0."""
    from ..operators.changes import product_total
    return product_total(_sold_products(t))


@register("contact_route")
def _contact_route(t: DomainTables) -> DataFrame:
    r = M.contact_route(t.incoming_contacts.select("id_crm", "email"), t.contacts)
    return r.select("id_crm", "email", "matches", "action")


@register("sync_metrics")
def _sync_metrics(t: DomainTables) -> DataFrame:
    r = M.contact_route(t.incoming_contacts.select("id_crm", "email"), t.contacts)
    return r.groupBy("action").agg(F.count(F.lit(1)).alias("records"))


# ---------------------------------------------------------------------------
# Validation
# ---------------------------------------------------------------------------

@register("lead_validation")
def _lead_validation(t: DomainTables) -> DataFrame:
    v = validated_export(t)
    return v.select("id", F.array_join("failed_fields", ",").alias("failed"),
                    (F.size("failed_fields") == 0).alias("valid"))


@register("missing_field_log")
def _missing_field_log(t: DomainTables) -> DataFrame:
    return Q.missing_field_log(validated_export(t))


@register("contact_validation")
def _contact_validation(t: DomainTables) -> DataFrame:
    v = Q.validate(t.crm_contacts, Q.CONTACT_REQUIRED)
    return v.select("id", "leadId", F.array_join("failed_fields", ",").alias("failed"),
                    (F.size("failed_fields") == 0).alias("valid"))


@register("contact_quarantine")
def _contact_quarantine(t: DomainTables) -> DataFrame:
    """Q-4/S15: incoming contacts that cannot be applied, with a reason."""
    r = M.contact_route(t.incoming_contacts, t.contacts)
    j = with_client(r, t)
    reason = (F.when(F.col("email").isNull(), "no_email").when(F.col("client_code").isNull(), "taxid_not_found")
              .when(F.col("action") == "ambiguous", "ambiguous_email"))
    return j.withColumn("reason", reason).where(F.col("reason").isNotNull()).select("id_crm", "lead_id", "reason")


# ---------------------------------------------------------------------------
# Change detection and merges
# ---------------------------------------------------------------------------

from ..operators.changes import field_diff  # noqa: E402


@register("field_diff")
def _field_diff(t: DomainTables) -> DataFrame:
    return field_diff(staged_leads(t), t.leads, "id", DIFF_FIELDS)


@register("upsert_leads")
def _upsert_leads(t: DomainTables) -> DataFrame:
    d = field_diff(staged_leads(t), t.leads, "id", DIFF_FIELDS).drop("tgt_id", "changed")
    out = M.merge_snapshot(t.leads, d, ["id"], DIFF_FIELDS)
    return out.withColumns({c: F.col(c).cast("double") for c in ("budget_value", "order_value")})


@register("stage_regression")
def _stage_regression(t: DomainTables) -> DataFrame:
    return M.stage_regression(t.leads, t.crm_export, STAGES_CANONICAL, ALIAS_TO_CANON)


@register("stage_update")
def _stage_update(t: DomainTables) -> DataFrame:
    # Every activation document acts, whatever documents of other stages come after it.
    docs = t.webhook_docs.where(F.col("stage") == ALIAS_TO_CANON[ACTIVATION_STAGE]).select(
        F.col("lead_id").alias("id"), F.lit(ACTIVATION_STAGE).alias("stage")).distinct()
    return M.merge_snapshot(t.leads, docs, ["id"], ["stage"], insert=False).select("id", "stage")


@register("stage_route")
def _stage_route(t: DomainTables) -> DataFrame:
    return M.route_by_stage(t.webhook_docs.select("doc_id", "lead_id", "stage"), "stage",
                            ALIAS_TO_CANON[BUDGET_STAGE], ALIAS_TO_CANON[ACTIVATION_STAGE])


PARTIAL_COLUMNS = ["id", "name", "phone", "stage", "taxid", "industry", "source", "address_zipcode",
                   "address_complement", "city", "state", "sales_rep", "tax_registration", "client_code",
                   "financial_analysis"]


@register("partial_update")
def _partial_update(t: DomainTables) -> DataFrame:
    """M2: webhook documents of synced-stage leads set the fields they carry."""
    from ..sources.webhook import is_synced, lead_update_fields
    raw = F.col("raw")
    docs = t.webhook_docs.where(is_synced(raw)).select(F.col("lead_id").alias("id"), "raw",
                                                         F.struct("received_at", "doc_id").alias("_ord"))
    updated = M.partial_update(t.leads, docs, "id", lead_update_fields(raw), "_ord")
    return set_address(updated, docs, t.crm_export.select("id", "street", "number", "district")).select(
        *PARTIAL_COLUMNS, "address_street", "address_number", "address_district")


#: Sources of a lead's fields, best first.
PRECEDENCE = ["document", "export", "custom field", "default"]


@register("lead_survivors")
def _lead_survivors(t: DomainTables) -> DataFrame:
    """Per lead of the CRM and field the value that survives, and its source."""
    from ..schemas import DEFAULTS
    from ..sources.webhook import is_synced, lead_update_fields
    raw = F.col("raw")
    fields = lead_update_fields(raw)
    docs = t.webhook_docs.where(is_synced(raw)).join(t.crm_export.select(F.col("id").alias("lead_id")), "lead_id", "left_semi")
    docs = dealt_evenly(docs.select("lead_id", "doc_id", "received_at", "raw"), t.webhook_docs.count(), "lead_id", "doc_id")
    document = candidates(docs, "lead_id", "document", {f: v for f, (v, _) in fields.items()},
                          F.col("received_at").cast("timestamp"), {f: p for f, (_, p) in fields.items()})
    e = dealt_evenly(t.crm_export, t.crm_export.count(), "id", "lead", "cnpj", task_rows=TASK_ROWS // 4)  # 13 values each
    export = candidates(e, "id", "export", {
        "name": F.col("lead"), "stage": _canon_to_alias(F.col("stage")), "taxid": F.col("cnpj"), "phone": X.strip_punct("phone1"),
        "industry": F.col("industry.value"), "source": F.col("source.value"), "address_street": F.col("street"),
        "address_number": X.house_number("number"), "address_district": F.col("district"), "address_zipcode": X.strip_punct("cep"),
        "address_complement": F.col("complement"), "city": F.col("city"), "state": F.col("state")})
    custom = candidates(custom_field_table(t), "lead_id", "custom field", {
        c: F.col(c) for c in ("sales_rep", "tax_registration", "financial_analysis", "client_code")})
    default = candidates(e, "id", "default", {c: F.lit(DEFAULTS[c]) for c in (
        "phone", "financial_analysis", "address_complement", "sales_rep", "state", "address_street")})
    every = document.unionByName(export).unionByName(custom).unionByName(default)
    return survivors(every, PRECEDENCE).withColumnRenamed("key", "id")


@register("contact_merge")
def _contact_merge(t: DomainTables) -> DataFrame:
    """Contact changes applied in the order they arrive."""
    return M.contact_merge(t.contact.select(*CONTACT), t.contact_changes, "seq")


@register("contact_merge_stream")
def _contact_merge_stream(t: DomainTables) -> DataFrame:
    """The same changes in three micro-batches; codes of contacts that a later one removes stay unused."""
    from ..streaming import ingest as I
    from ..streaming.contacts import ContactSink
    root = _scratch(t, "contact-stream")
    sink = ContactSink(f"{root}/tables", t.contact, "seq")
    I.sync_in_order(t.contact_changes, f"{root}/queue", 3, ["seq"], f"{root}/ckpt", sink)
    return sink.current(t.spark).select(*[c for c in CONTACT if c != "code"])


@register("store_crm_id")
def _store_crm_id(t: DomainTables) -> DataFrame:
    """M7: write the CRM id back to the branch with that tax id."""
    pairs = t.crm_export.where(F.col("cnpj").isNotNull()).select(F.col("cnpj").alias("taxid"),
                                                                 F.col("id").alias("id_crm"))
    b = t.branches.select("client", "code", "taxid", "id_crm", "integrate_crm")
    return M.write_back(b, pairs, F.col("taxid"), "taxid",
                        {"id_crm": F.col("_p_id_crm"), "integrate_crm": F.lit(True)})


@register("store_contact_id")
def _store_contact_id(t: DomainTables) -> DataFrame:
    """M8: write the CRM contact id back by lower-case e-mail."""
    pairs = (t.crm_contacts.where(F.col("email").isNotNull())
             .select(F.lower("email").alias("email"), F.col("id").alias("id_crm")))
    c = t.contact.select("code", "email", "id_crm")
    return M.write_back(c, pairs, F.lower(F.col("email")), "email", {"id_crm": F.col("_p_id_crm")})


# ---------------------------------------------------------------------------
# Client cascade (M9-M14), inserts, error log
# ---------------------------------------------------------------------------

@register("branch_update")
def _branch_update(t: DomainTables) -> DataFrame:
    from ..operators.cascade import branch_update
    return branch_update(matched_changes(t), t.cities, t.states)


def _cascade(t: DomainTables) -> dict[str, DataFrame]:
    from ..operators.cascade import new_clients
    return new_clients(staged_leads(t), t.branches, t.cities, t.states, t.industries)


#: M9: the tables that new clients are rows of, by their keys.
for _key, _table in {"new_clients": "branches", "new_client_companies": "clients", "new_client_reps": "sales_rep_branches",
                     "new_client_billing": "billing_addresses", "new_client_history": "credit_limit_history",
                     "new_client_industries": "client_industries"}.items():
    register(_key)(lambda t, _table=_table: _cascade(t)[_table])


@register("lead_rejects")
def _lead_rejects(t: DomainTables) -> DataFrame:
    """M9: leads that act on no client, with the reason."""
    from ..operators.cascade import rejected_leads
    return rejected_leads(staged_leads(t))


@register("industry_change")
def _industry_change(t: DomainTables) -> DataFrame:
    """Industries that leads change at their clients."""
    from ..operators.cascade import industry_change
    return industry_change(matched_changes(t), t.industries)


@register("cascade_stream")
def _cascade_stream(t: DomainTables) -> DataFrame:
    """The cascade per micro-batch, all its tables under one manifest; leads come in the order of their tax ids,
    so that the blocks of client codes follow one another as in the batch."""
    from ..streaming import ingest as I
    from ..streaming.cascade import CascadeSink
    root = _scratch(t, "cascade-stream")
    leads = staged_leads(t)
    sink = CascadeSink(f"{root}/erp", V.client_base(t).join(V.min_industry(t), V.KEYS, "left"), t.branches, t.cities, t.states,
                       t.credit_limit_history, t.industries)
    I.sync_in_order(leads, f"{root}/queue", 3, ["taxid", "id"], f"{root}/ckpt", sink)
    return sink.table(t.spark, "branches").drop("epoch")


@register("next_sequence")
def _next_sequence(t: DomainTables) -> DataFrame:
    m = matched_changes(t).where(F.col("financial_analysis").isNotNull())
    rows = m.select(F.col("erp_client_code").alias("client_code"), F.col("financial_analysis").alias("observations"),
                    F.col("id").alias("lead_id"))
    return M.next_sequence(t.credit_limit_history, rows, "client_code", "sequence", "lead_id")


@register("insert_ignore")
def _insert_ignore(t: DomainTables) -> DataFrame:
    rows = t.crm_contacts.select(F.col("id").alias("id_crm"), "name", F.lower("email").alias("email"))
    return M.insert_ignore(t.contact.select("id_crm"), rows, ["id_crm"])


_LOG_CODE = -20012


def _log_info() -> Column:
    return F.concat(F.lit("missing: "), F.array_join("failed_fields", ","))


@register("error_log_rows")
def _error_log_rows(t: DomainTables) -> DataFrame:
    rejects = validated_export(t).where(F.size("failed_fields") > 0)
    out = Q.error_log_rows(rejects, t.error_log, _LOG_CODE, _log_info(), order=["id"])
    return out.select("log_id", "errorcode", "error_info", "id")


@register("error_log_stream")
def _error_log_stream(t: DomainTables) -> DataFrame:
    """The same log, written by micro-batches that reserve their ids."""
    from ..streaming import ingest as I
    from ..streaming.epochs import ErrorLogSink
    root = _scratch(t, "error-log-stream")
    rejects = validated_export(t).where(F.size("failed_fields") > 0).select("id", "failed_fields")
    start = t.error_log.agg(F.max("log_id")).first()[0]
    sink = ErrorLogSink(f"{root}/log", start, _LOG_CODE, _log_info(), ["id"])
    I.sync_in_order(rejects, f"{root}/queue", 3, ["id"], f"{root}/ckpt", sink)
    schema = "log_id bigint, errorcode bigint, error_info string, id bigint"
    return sink.log(t.spark, schema).drop("epoch")


@register("replace_product")
def _replace_product(t: DomainTables) -> DataFrame:
    from ..schemas import BUDGET_PRODUCT_ID
    cur = (t.sale_lines.groupBy("lead_id", "product_id")
           .agg(F.sum(F.coalesce("final_value", F.lit(0))).cast("double").alias("value")))
    new = V.budget_changes(t).select(F.col("id").alias("lead_id"),
                                     F.lit(BUDGET_PRODUCT_ID).cast("bigint").alias("product_id"),
                                     F.col("budget_value").alias("value"))
    return M.replace_product(cur, new, ["lead_id", "product_id"])


@register("mark_values")
def _mark_values(t: DomainTables) -> DataFrame:
    """Set budget / order values; a lead the CRM already shows as sold
    (Activation, Retention) also takes the CRM stage."""
    new = V.value_changes(t).select(F.col("id").alias("_vid"), F.col("budget_value").alias("_bv"), F.col("order_value").alias("_ov"))
    crm = t.crm_export.select(F.col("id").alias("_cid"), _canon_to_alias(F.col("stage")).alias("_cstage"))
    j = (t.leads.join(new, F.col("id") == F.col("_vid"), "left").join(crm, F.col("id") == F.col("_cid"), "left"))
    sold = F.col("_cstage").isin(ACTIVATION_STAGE, "Retention/Expansion")
    return j.select(
        "id",
        F.coalesce(F.col("_bv"), F.col("budget_value").cast("double")).alias("budget_value"),
        F.coalesce(F.col("_ov"), F.col("order_value").cast("double")).alias("order_value"),
        F.when(F.col("_bv").isNotNull() & sold, F.col("_cstage")).otherwise(F.col("stage")).alias("stage"))


def _reload(t: DomainTables) -> dict[str, DataFrame]:
    """Valid CRM leads of the synced stages in the lead schema, shaped
    as the full sync loads them (name cut to 40, street = first word, zip
    without punctuation, registration '99' shown as ISENTO)."""
    e = t.crm_export.withColumn("stage", X.nbsp_to_space(F.col("stage")))
    cf = custom_field_table(t)
    e = e.join(cf, e.id == F.col("lead_id"), "left").drop("lead_id")
    reg = F.col("tax_registration")
    proj = ["id", X.truncate(F.col("lead"), 40).alias("name"), _canon_to_alias(F.col("stage")).alias("stage"),
            F.col("cnpj").alias("taxid"), F.col("industry.value").alias("industry"),
            F.col("source.value").alias("source"), F.col("phone1").alias("phone"),
            X.first_token(F.col("street")).alias("address_street"),
            X.strip_punct(F.col("cep")).alias("address_zipcode"),
            X.house_number(F.col("number")).alias("address_number"), F.col("complement").alias("address_complement"),
            F.col("district").alias("address_district"), "city", "state",
            F.col("sales_rep").try_cast("bigint").alias("sales_rep"),
            F.when(reg == "99", F.lit("ISENTO")).otherwise(reg).alias("tax_registration"), "financial_analysis"]
    return Q.full_reload(e, t.crm_contacts, proj, sales_rep=F.col("sales_rep"))


@register("full_reload")
def _full_reload(t: DomainTables) -> DataFrame:
    return _reload(t)["leads"]


# ---------------------------------------------------------------------------
# Nested data, sources
# ---------------------------------------------------------------------------

@register("json_props")
def _json_props(t: DomainTables) -> DataFrame:
    e = t.raw("events")
    parsed = F.from_json(F.col("props"), "k bigint")
    w = t.webhook_docs.select("doc_id", F.get_json_object("raw", "$.Lead.Stage").alias("stage"))
    return (e.select("event_id", parsed["k"].alias("k"))
            .join(w, F.col("event_id") == F.col("doc_id")).select("event_id", "k", "stage"))


@register("field_split")
def _field_split(t: DomainTables) -> DataFrame:
    d = t.lead_docs.join(t.leads.select("id", "name", "city"), "id")
    entries = F.concat(F.array(F.struct(F.lit("name").alias("key"), F.col("name").alias("value")),
                               F.struct(F.lit("city").alias("key"), F.col("city").alias("value"))),
                       F.transform("CustomFields", lambda x: F.struct(x["id"].alias("key"), x["value"].alias("value"))))
    plain, custom = X.split_custom(entries)
    return d.select("id", F.size(plain).cast("bigint").alias("plain_fields"),
                    F.size(custom).cast("bigint").alias("custom_fields"),
                    F.array_join(F.transform(custom, lambda x: x["key"]), ",").alias("custom_keys"))


@register("array_append_field")
def _array_append(t: DomainTables) -> DataFrame:
    d = t.lead_docs
    arr = X.append_custom_field(F.col("CustomFields"), "_observacao", F.lit("Vazio."))
    return d.select("id", F.size(arr).cast("bigint").alias("fields"),
                    F.element_at(arr, -1)["id"].alias("last_id"), F.element_at(arr, -1)["value"].alias("last_value"))


@register("sold_products")
def _sold_products(t: DomainTables) -> DataFrame:
    """Per lead, the products of its first sale (earliest date, then
    lowest sale id), one row each."""
    lines = t.sale_lines
    first = lines.groupBy("lead_id").agg(F.min(F.struct("sale_date", "sale_id")).alias("f")).select(
        "lead_id", F.col("f.sale_id").alias("sale_id"))  # the key alone; lines are read once more, for it
    return lines.join(first, ["lead_id", "sale_id"]).select(
        "lead_id", "sale_id", "sale_date", "line", "product_id", F.col("final_value").cast("double").alias("final_value"))


@register("option_domain")
def _option_domain(t: DomainTables) -> DataFrame:
    d = t.lead_docs.select(F.explode("CustomFields").alias("f"))
    return d.where(F.col("f.id") == CF_SALES_REP).select(F.col("f.value").alias("value")).distinct()


def _landed(t: DomainTables) -> DataFrame:
    """The CRM's listings, landed as JSON pages and read back."""
    root = _scratch(t, "pages")
    t.landed_pages.write.partitionBy("listing").json(root)
    schema = T.StructType([f for f in t.landed_pages.schema if f.name != "listing"] + [T.StructField("listing", T.StringType())])
    return t.spark.read.schema(schema).json(root)


@register("page_explode")
def _page_explode(t: DomainTables) -> DataFrame:
    """The leads of complete listings, each from the last page it stands on."""
    from ..sources.readers import explode_listings
    return explode_listings(_landed(t)).select("listing", "page", F.col("item.id").alias("id"), F.col("item.lead").alias("lead"))


@register("page_report")
def _page_report(t: DomainTables) -> DataFrame:
    """What of each listing landed; unfinished and holed ones are held back."""
    from ..sources.readers import listing_report
    return listing_report(_landed(t))


@register("json_roundtrip")
def _json_roundtrip(t: DomainTables) -> DataFrame:
    """Queue the insert candidates as JSON lines (all part files, NULL
    fields kept) and read them back with the schema, lower-cased."""
    import uuid
    from ..session import checkpoint_dir
    from ..sources.readers import read_json_lines
    from ..sources.sinks import write_queue
    df = V.insert_candidates(t)
    path = f"{checkpoint_dir(t.spark).rstrip('/')}/queue/insert/{uuid.uuid4().hex}"
    write_queue(df.toDF(*[c.upper() for c in df.columns]), path)
    return read_json_lines(t.spark, path, df.toDF(*[c.upper() for c in df.columns]).schema)


# ---------------------------------------------------------------------------
# Payloads
# ---------------------------------------------------------------------------

@register("insert_payload")
def _insert_payload(t: DomainTables) -> DataFrame:
    from ..operators.payloads import insert_payload
    c = V.insert_candidates(t)
    c = J.domain_or_default(c, "sales_rep", rep_options(t), "code", 99, out="sales_rep_checked")
    return insert_payload(c)


@register("update_payload")
def _update_payload(t: DomainTables) -> DataFrame:
    from ..operators.payloads import update_payload
    d = J.domain_or_default(V.lead_diff(t), "sales_rep", rep_options(t), "code", 99, out="sales_rep_checked")
    return update_payload(d)


@register("contact_payload")
def _contact_payload(t: DomainTables) -> DataFrame:
    from ..operators.payloads import contact_payload
    return contact_payload(V.contact_diff(t))


@register("budget_payload")
def _budget_payload(t: DomainTables) -> DataFrame:
    from ..operators.payloads import budget_payload
    return budget_payload(V.budget_changes(t))


@register("sale_payload")
def _sale_payload(t: DomainTables) -> DataFrame:
    from ..operators.payloads import sale_payload
    return sale_payload(V.sold_changes(t))


@register("observation_payload")
def _observation_payload(t: DomainTables) -> DataFrame:
    from ..operators.payloads import observation_payload
    c = t.contacts.select("id", F.when(F.col("is_primary"), "S").otherwise("N").alias("flag"))
    return observation_payload(c, "flag")


# ---------------------------------------------------------------------------
# Streaming (documents landed from the events table into a fresh queue)
# ---------------------------------------------------------------------------

def _scratch(t: DomainTables, name: str) -> str:
    import uuid
    from ..session import checkpoint_dir
    return f"{checkpoint_dir(t.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("stream_ingest")
def _stream_ingest(t: DomainTables) -> DataFrame:
    """Queue -> bounded micro-batches -> sink, checkpointed, archived."""
    from ..streaming import ingest as S_
    root = _scratch(t, "stream-ingest")
    files = S_.files_for(t.webhook_docs)
    S_.land_documents(t.webhook_docs, f"{root}/queue", files)
    s = S_.read_queue(t.spark, f"{root}/queue", max_files=files // 4, archive_dir=f"{root}/archive")
    q = S_.start_sync(s.select("doc_id", "lead_id", "kind", "stage"), f"{root}/ckpt", S_.append_sink(f"{root}/out"))
    q.awaitTermination()
    return t.spark.read.parquet(f"{root}/out").drop("epoch")


@register("stream_upsert")
def _stream_upsert(t: DomainTables) -> DataFrame:
    """Micro-batches append per-field changes to a log; the snapshot
    (base + log) equals the batch ``partial_update``."""
    from ..streaming import ingest as S_
    root = _scratch(t, "stream-upsert")
    files = S_.files_for(t.webhook_docs)
    S_.land_documents(t.webhook_docs, f"{root}/queue", files)
    s = S_.read_queue(t.spark, f"{root}/queue", max_files=files // 4)
    merge = S_.ChangeLogMerge(f"{root}/leads")
    q = S_.start_sync(s, f"{root}/ckpt", merge)
    q.awaitTermination()
    return merge.snapshot(t.spark, t.leads).select(*PARTIAL_COLUMNS)


@register("stream_dedup")
def _stream_dedup(t: DomainTables) -> DataFrame:
    """Every document landed twice; the stream keeps one per fingerprint."""
    from ..streaming import ingest as S_
    from ..streaming.dedup import LedgerDedup
    root = _scratch(t, "stream-dedup")
    files = S_.files_for(t.webhook_docs)
    S_.land_documents(t.webhook_docs, f"{root}/queue/a", files)
    S_.land_documents(t.webhook_docs, f"{root}/queue/b", files)
    s = S_.read_queue(t.spark, f"{root}/queue/*", max_files=files // 2)
    # A fingerprint stays known for good, in the written ledger.
    sink = LedgerDedup(f"{root}/out", ["doc_id", "lead_id", "kind", "stage", "raw"], ["doc_id", "lead_id", "kind"])
    q = S_.start_sync(s, f"{root}/ckpt", sink)
    q.awaitTermination()
    return t.spark.read.parquet(sink.documents).drop("epoch")


@register("client_code_payload")
def _client_code_payload(t: DomainTables) -> DataFrame:
    """Write the generated client code back to each new lead."""
    from ..operators.cascade import new_clients
    from ..operators.documents import client_code_payload
    return client_code_payload(new_clients(staged_leads(t), t.branches, t.cities, t.states)["branches"])


@register("placeholder_contact_payload")
def _placeholder_contact(t: DomainTables) -> DataFrame:
    """Leads in the synced stages with no CRM contact get a placeholder."""
    from ..operators.documents import placeholder_contact_payload
    leads = t.leads.where(F.col("stage").isin(*SYNCED_STAGES))
    no_contact = J.exclude(leads, "id", t.crm_contacts, "leadId")
    return placeholder_contact_payload(no_contact)


@register("contact_upsert")
def _contact_upsert(t: DomainTables) -> DataFrame:
    """M5: incoming CRM contacts upserted into the CRM-copy contact table."""
    clients = t.leads.select(F.col("id").alias("lead_id"), "client_code")
    return M.contact_upsert(t.contacts, t.incoming_contacts, clients)


@register("converted_insert")
def _converted_insert(t: DomainTables) -> DataFrame:
    """Leads that reached the budget stage in the CRM, built from their
    latest document and the CRM export, appended unless the id exists."""
    canon = ALIAS_TO_CANON[BUDGET_STAGE]
    docs = t.webhook_docs.where(X.nbsp_to_space(F.get_json_object("raw", "$.Lead.Stage")) == canon)
    docs = docs.where(~F.col("lead_id").isin(*EXCLUDED_LEAD_IDS))
    rows = M.converted_lead_rows(docs, t.crm_export, BUDGET_STAGE)
    return M.insert_ignore(t.leads.select("id"), rows, ["id"])


@register("stream_chain")
def _stream_chain(t: DomainTables) -> DataFrame:
    """Lead changes and the contact fan-out of accepted leads in one
    foreachBatch; the fan-out equals the batch ``contact_fanout``."""
    from ..streaming import ingest as S_
    root = _scratch(t, "stream-chain")
    files = S_.files_for(t.webhook_docs)
    S_.land_documents(t.webhook_docs, f"{root}/queue", files)
    chain = S_.LeadChangeChain(f"{root}/out", t.leads.select("id"))
    q = S_.start_sync(S_.read_queue(t.spark, f"{root}/queue", max_files=files // 4), f"{root}/ckpt", chain)
    q.awaitTermination()
    return t.spark.read.parquet(f"{root}/out/contacts").drop("epoch")


# ---------------------------------------------------------------------------
# Documents by kind (R1, Q-5)
# ---------------------------------------------------------------------------

def _queue(t: DomainTables):
    """The queue read as a stream of three micro-batches and split into kinds; run once per set of tables."""
    from ..streaming import ingest as I
    from ..streaming.kinds import KindSink
    if "_kind_sink" not in t.__dict__:
        root = _scratch(t, "kinds")
        sink = KindSink(f"{root}/tables")
        I.sync_in_order(t.queue_documents, f"{root}/queue", 3, ["seq"], f"{root}/ckpt", sink)
        t.__dict__["_kind_sink"] = sink
    return t.__dict__["_kind_sink"]


_LEAD_FIELDS = {"Lead.Id": "lead_id", "Lead.Company": "company", "Lead.Stage": "stage", "Lead.Address.City": "city"}
for _kind, _fields in {"lead_update": _LEAD_FIELDS, "lead_converted": _LEAD_FIELDS,
                       "contact_update": {"Id": "id", "Name": "name", "Email": "email"},
                       "timeline": {"Id": "id", "LeadId": "lead_id", "Text": "text"}}.items():
    register(f"kind_{_kind}")(lambda t, _kind=_kind, _fields=_fields: _queue(t).read(t.spark, _kind).select(
        "file", *[F.col(path).alias(name) for path, name in _fields.items()]))


@register("dead_letters")
def _dead_letters(t: DomainTables) -> DataFrame:
    return _queue(t).read(t.spark, "dead_letters").select("file", "kind", "reason")


@register("document_selection")
def _document_selection(t: DomainTables) -> DataFrame:
    """P10: the converted documents of leads that the ERP knows."""
    from ..operators.documents import docs_for_leads
    docs = _queue(t).read(t.spark, "lead_converted").withColumnRenamed("file", "source_file")
    return docs_for_leads(docs, t.leads).select("source_file", F.col("Lead.Id").alias("lead_id"))


@register("batch_names")
def _batch_names(t: DomainTables) -> DataFrame:
    """the queue file name of each document."""
    from ..operators.documents import batch_name
    d = t.webhook_docs
    return d.select("doc_id", batch_name("update_leads_in_erp", F.col("company"), F.col("doc_id"), F.col("received_at")).alias("file"))


@register("outcome_class")
def _outcome_class(t: DomainTables) -> DataFrame:
    """Q-7: outcomes of the calls that sent documents (the event's number plays status and message)."""
    from ..operators.documents import classify_outcome
    k = F.col("event_id")
    status = F.when(k % 7 == 0, 400).when(k % 11 == 0, 500).otherwise(200 + k % 3)
    message = F.when(k % 14 == 0, F.lit("Duplicated Keys: _cod.cliente")).when(k % 7 == 0, F.lit("Duplicated Keys: phone")).otherwise(F.lit("ok"))
    return t.raw("events").select("event_id", classify_outcome(status, message).alias("outcome"))


@register("industry_load")
def _industry_load(t: DomainTables) -> DataFrame:
    """The CRM's industry list loaded over the ERP's."""
    from ..operators.documents import load_industries
    listed = t.raw("part").select((F.col("p_partkey") % 8).alias("industry"), F.concat(F.lit("Trade "), F.col("p_partkey") % 8).alias("description"))
    return load_industries(t.industries.select("industry", "description"), listed)


@register("phone_digits")
def _phone_digits(t: DomainTables) -> DataFrame:
    """phones of the CRM's leads, digits alone."""
    from ..operators.payloads import clean_digits
    return t.crm_export.select("id", clean_digits("phone1").alias("phone"))


@register("main_contact")
def _main_contact(t: DomainTables) -> DataFrame:
    """Whether a contact is the main one, searched in its lead's array of contacts."""
    k = F.col("event_id")
    listed = F.array(*[F.struct((k * 10 + i).alias("id"), F.when(k % 3 == i, "true").otherwise("false").alias("mainContact"))
                       for i in range(3)])
    asked = k * 10 + k % 5  # some are not in the list
    return t.raw("events").select(asked.alias("id"), X.main_contact_flag(listed, asked).alias("is_primary"))


@register("reload_contacts")
def _reload_contacts(t: DomainTables) -> DataFrame:
    """The contacts that the full reload keeps."""
    return _reload(t)["contacts"].select("id", "leadId", "name", "email", "phone1", "jobTitle")


@register("reload_rejects")
def _reload_rejects(t: DomainTables) -> DataFrame:
    """Leads and contacts that the full reload refuses, with the reason."""
    out = _reload(t)
    return out["lead_rejects"].select(F.lit("lead").alias("kind"), "id", "reason").unionByName(
        out["contact_rejects"].select(F.lit("contact").alias("kind"), "id", "reason"))
