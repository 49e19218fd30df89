"""Composite views (V1-V9) and the per-client measures they need.

The source views call correlated scalar functions once per client row.  Here
every scalar becomes a grouped aggregate keyed by (client, branch), computed
once over the whole fact tables (partial aggregation before the shuffle, so a
client holding a third of the rows costs one pre-aggregated row per task),
and then left-joined to the client rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import (bool_to_yn, day_window, decode_eq, initcap_words, oracle_concat, plus_days,
                              price_fallback, pad_taxid, trunc_day, ts_ntz)
from ..schemas import BUDGET_VALUE_OVERRIDES, ORDER_VALUE_OVERRIDES, SYNCED_STAGES
from ..sources.standins import DomainTables
from ..operators.setops import chained_diff

BASE_TS = "1998-01-01 00:00:00"
KEYS = ["client_code", "branch_code"]


def _base(base_ts) -> Column:
    return ts_ntz(base_ts) if isinstance(base_ts, str) else base_ts


def _by(t: DomainTables, df: DataFrame, key: str) -> DataFrame:
    """Hash-partition ``df`` on ``key`` unless the tables are already
    bucketed on it (then the buckets are used as they are)."""
    return df if t.bucketed else df.repartition(key)


def _in_window(col: Column, base_ts, days: int) -> Column:
    """``TRUNC(col) BETWEEN base AND base + days``; literal range bounds (pushed
    to the scan) when the base is a constant."""
    if isinstance(base_ts, str):
        return day_window(col, base_ts, days)
    day = trunc_day(col)
    return (day >= base_ts) & (day <= plus_days(base_ts, days))


def with_override(client: Column, value: Column, overrides: dict) -> Column:
    """V9: fixed value for listed clients, else the computed one."""
    if not overrides:
        return value
    m = F.create_map(*[x for k, v in overrides.items() for x in (F.lit(k).cast("bigint"), F.lit(v).cast("double"))])
    return F.coalesce(F.try_element_at(m, client.cast("bigint")), value)


# ---------------------------------------------------------------------------
# Client base (J1) and per-client measures
# ---------------------------------------------------------------------------

def client_base(t: DomainTables) -> DataFrame:
    """Branch ⋈ client ⋈ city ⋈ country ⋈ state, with display columns.

    The geography tables are dimension-sized; Catalyst broadcasts them when
    their estimated size is under the broadcast threshold, else sort-merge.
    """
    b = t.branches
    c = t.clients.select(F.col("client_code").alias("_c"))
    ct = t.cities.select(F.col("id").alias("_city"), "city_code", "city_name", "state_code",
                         F.col("country_code").alias("_country"))
    p = t.countries.select(F.col("code").alias("_pcode"), F.col("name").alias("_pname"))
    s = t.states.select(F.col("code").alias("_scode"), F.col("name").alias("_sname"))
    j = (b.join(c, b.client == c._c)
          .join(ct, b.city == ct._city)
          .join(p, p._pcode == ct._country)
          .join(s, ct.state_code == s._scode))
    return j.select(
        oracle_concat(b.client, F.lit("-"), b.code).alias("id"),
        b.client.alias("client_code"),
        b.code.alias("branch_code"),
        b.description.alias("company_name"),
        b.taxid,
        b.sales_rep,
        initcap_words(F.col("_pname")).alias("country"),
        decode_eq(F.col("_pcode"), "US", initcap_words(F.col("_sname"))).alias("state"),
        initcap_words(F.col("city_name")).alias("city"),
        F.col("city_code"),
        b.zipcode.alias("address_zipcode"),
        b.address.alias("address_street"),
        b.number.alias("address_number"),
        b.district.alias("address_district"),
        b.complement.alias("address_complement"),
        b.email,
        b.tax_registration,
        b.phone,
        b.id_crm,
        bool_to_yn(F.coalesce(b.integrate_crm, F.lit(False))).alias("integrate_crm"),
    )


def min_industry(t: DomainTables) -> DataFrame:
    """A4: smallest display name of a client-branch's industries."""
    ci = t.client_industries
    m = t.industries
    j = ci.join(m, ci.industry == m.industry)
    return (j.groupBy(F.col("client").alias("client_code"), F.col("branch").alias("branch_code"))
            .agg(F.min(initcap_words(F.col("description"))).alias("industry")))


def latest_observation(t: DomainTables) -> DataFrame:
    """A5: per client, the largest observation among rows at the latest date.

    ``max(struct(date, obs))`` picks it in one aggregate (no self-join):
    struct order is date first, then observation, and NULL observations sort
    below any text, like ``max`` ignoring them.  NULL dates never equal the
    latest date, so they are dropped first.
    """
    h = t.credit_limit_history.where(F.col("date").isNotNull())
    return (h.groupBy("client_code")
            .agg(F.max(F.struct("date", "observations")).alias("_m"))
            .select("client_code", F.col("_m.observations").alias("financial_analysis")))


def order_lines(t: DomainTables) -> DataFrame:
    """Sales-order items with their client-branch (person keys)."""
    so = t.sales_order
    it = t.sales_order_item
    return it.join(so, (so.company_code == it.so_company_code) & (so.number == it.so_number))


def _to_person(per_pers: DataFrame, t: DomainTables) -> DataFrame:
    d = t.person
    return (per_pers.join(d, per_pers.pers_code == d.code)
            .drop("pers_code", "code")
            .withColumnRenamed("key1", "client_code").withColumnRenamed("key2", "branch_code"))


def order_value(t: DomainTables, base_ts=BASE_TS, horizon_days: int = 365, overrides=None) -> DataFrame:
    """Σ item qty × unit value of billed deliveries whose item day is
    within [base, base + horizon]; clients without items are absent (NULL)."""
    it = t.sales_order_item
    it = it.where(_in_window(it.item_date, base_ts, horizon_days))
    e = t.sales_order_item_delivery.where(F.col("billing_client") == "Y")
    so = t.sales_order
    # Items, deliveries and orders are all keyed by order number first: each
    # side is shuffled once on it and both joins run inside the partitions.
    it, e, so = _by(t, it, "so_number"), _by(t, e, "sod_number"), _by(t, so, "number")
    j = (it.join(e, (it.so_company_code == e.sod_company_code) & (it.so_number == e.sod_number)
                 & (it.sequence == e.sequence))
           .join(so, (so.company_code == it.so_company_code) & (so.number == it.so_number)))
    # Aggregate before the person join: one row per person reaches it.
    per = j.groupBy("pers_code").agg(F.sum(F.col("item_qty") * F.col("unit_value")).alias("_v"))
    out = _to_person(per, t).groupBy(*KEYS).agg(F.sum("_v").alias("_v"))
    return out.select(*KEYS, F.col("_v").cast("double").alias("order_value"))


def order_presence(t: DomainTables, base_ts=BASE_TS, retention_days: int = 30) -> DataFrame:
    """Has an order item on or after base (``has_order``) and on or
    after base + 30 days (``has_retention``), from one max(item_date) pass."""
    base = _base(base_ts)
    per = (order_lines(t).where(F.col("item_date") >= base)
           .groupBy("pers_code").agg(F.max("item_date").alias("_last")))
    out = _to_person(per, t).groupBy(*KEYS).agg(F.max("_last").alias("_last"))
    return out.select(*KEYS, F.lit("Y").alias("has_order"),
                      bool_to_yn(F.col("_last") >= plus_days(base, retention_days)).alias("has_retention"))


def order_measures(t: DomainTables, base_ts=BASE_TS, horizon_days: int = 365, retention_days: int = 30) -> DataFrame:
    """A2 + J17 + V8 in one pass over the order items: the items on or after
    base (a superset of the value window) are joined once to their orders and
    billed deliveries, and one aggregate per person gives the order value
    (window rows only), ``has_order`` and ``has_retention``."""
    if not isinstance(base_ts, str):
        return order_presence(t, base_ts, retention_days).join(order_value(t, base_ts, horizon_days), KEYS, "full")
    base = _base(base_ts)
    it = t.sales_order_item.where(F.col("item_date") >= base)
    e = t.sales_order_item_delivery.where(F.col("billing_client") == "Y")
    so = t.sales_order
    it, e, so = _by(t, it, "so_number"), _by(t, e, "sod_number"), _by(t, so, "number")
    j = (it.join(e, (it.so_company_code == e.sod_company_code) & (it.so_number == e.sod_number)
                 & (it.sequence == e.sequence), "left")
           .join(so, (so.company_code == it.so_company_code) & (so.number == it.so_number)))
    v = F.when(_in_window(F.col("item_date"), base_ts, horizon_days), F.col("item_qty") * F.col("unit_value"))
    per = j.groupBy("pers_code").agg(F.sum(v).alias("_v"), F.max("item_date").alias("_last"))
    out = _to_person(per, t).groupBy(*KEYS).agg(F.sum("_v").alias("_v"), F.max("_last").alias("_last"))
    return out.select(*KEYS, F.col("_v").cast("double").alias("order_value"), F.lit("Y").alias("has_order"),
                      bool_to_yn(F.col("_last") >= plus_days(base, retention_days)).alias("has_retention"))


def has_order(t: DomainTables, base_ts=BASE_TS) -> DataFrame:
    """X4 for every branch: (client, branch, 'Y'/'N')."""
    p = order_presence(t, base_ts).select(*KEYS, "has_order")
    b = t.branches.select(F.col("client").alias("client_code"), F.col("code").alias("branch_code"))
    return b.join(p, KEYS, "left").select(*KEYS, F.coalesce("has_order", F.lit("N")).alias("has_order"))


def has_budget(t: DomainTables, base_ts=BASE_TS) -> DataFrame:
    """A generated budget item dated on or after base."""
    base = _base(base_ts)
    i = t.budget_item.where((F.col("date") >= base) & (F.col("generated") != "N"))
    o = t.budget
    hit = (o.join(i, o.number == i.bdg_number, "left_semi")
           .select(F.col("client_billing_code").alias("client_code"),
                   F.col("branch_billing_code").alias("branch_code")).distinct())
    b = t.branches.select(F.col("client").alias("client_code"), F.col("code").alias("branch_code"))
    return (b.join(hit.withColumn("_y", F.lit(1)), KEYS, "left")
            .select(*KEYS, bool_to_yn(F.col("_y").isNotNull()).alias("has_budget")))


def has_service_order(t: DomainTables, base_ts=BASE_TS) -> DataFrame:
    """A non-cancelled service-order item created on or after base."""
    base = _base(base_ts)
    i = t.service_order_item.where((F.col("create_date") >= base) & (F.col("status") != "C"))
    o = t.service_order
    cond = ((o.company_code == i.soi_company_code) & (o.branch_code == i.soi_branch_code)
            & (o.sales_rep_code == i.soi_sales_rep_code) & (o.number == i.soi_number))
    hit = (o.join(i, cond, "left_semi")
           .select(F.col("client").alias("client_code"), F.col("branch").alias("branch_code")).distinct())
    b = t.branches.select(F.col("client").alias("client_code"), F.col("code").alias("branch_code"))
    return (b.join(hit.withColumn("_y", F.lit(1)), KEYS, "left")
            .select(*KEYS, bool_to_yn(F.col("_y").isNotNull()).alias("has_service_order")))


def min_tier(t: DomainTables) -> DataFrame:
    """A3: rows of each budget item at its smallest quantity (ties kept)."""
    from pyspark.sql import Window
    q = _by(t, t.budget_item_quantity, "bit_bdg_number")
    w = Window.partitionBy("bit_bdg_number", "bit_item")
    return q.withColumn("_min", F.min("quantity").over(w)).where(F.col("quantity") == F.col("_min")).drop("_min")


def budget_value(t: DomainTables, base_ts=BASE_TS, horizon_days: int = 365) -> DataFrame:
    """Σ tier quantity / 1000 × (negotiated price, or list price when
    null/0) at each item's smallest tier, for approved client-billed items of
    generated budgets dated within [base, base + horizon].

    All joins are keyed by budget number first, so each input is shuffled
    once on it (or read from buckets on it); the tier minimum is a hash
    aggregate over the same key.
    """
    i = t.budget_item
    i = i.where(_in_window(i.date, base_ts, horizon_days) & (i.generated != "N"))
    o = t.budget
    # Smallest tier per budget item as a hash aggregate (partial, no sort);
    # the delivery join below keeps only rows at that quantity, which is the
    # same as joining the tier rows at their minimum (A3).
    q = (_by(t, t.budget_item_quantity, "bit_bdg_number")
         .groupBy("bit_bdg_number", "bit_item").agg(F.min("quantity").alias("quantity")))
    e = t.budget_item_quant_delivery
    ie = (t.budget_item_delivery.where((F.col("billing_client") == "Y") & F.col("approval_date").isNotNull())
          .select(F.col("bit_bdg_number").alias("ie_bdg"), F.col("bit_item").alias("ie_item"),
                  F.col("client_code").alias("ie_client"), F.col("branch_code").alias("ie_branch")))
    # Co-partition every budget input on the budget number: one shuffle per
    # input, then the tier minimum and the three joins (whose keys all start
    # with the budget number) run partition-local.  Budget numbers are
    # fine-grained, so a hot client does not make a hot partition here; the
    # per-client sum below is pre-aggregated before its own shuffle.
    i = _by(t, i, "bdg_number")
    e, ie = _by(t, e, "bid_bdg_number"), _by(t, ie, "ie_bdg")
    j = (i.join(o, o.number == i.bdg_number)
          .join(q, (q.bit_bdg_number == i.bdg_number) & (q.bit_item == i.item))
          .join(e, (e.bid_bdg_number == q.bit_bdg_number) & (e.bid_item == q.bit_item)
                & (e.bid_quantity == q.quantity))
          .join(ie, (ie.ie_bdg == i.bdg_number) & (ie.ie_item == i.item)
                & (e.client_code == ie.ie_client) & (e.branch_code == ie.ie_branch)))
    v = F.col("quantity") * price_fallback(F.col("negotiated_price"), F.col("price"))
    agg = (j.groupBy(F.col("client_billing_code").alias("client_code"),
                     F.col("branch_billing_code").alias("branch_code"))
           .agg(F.sum(v).alias("_v")))
    return agg.select(*KEYS, (F.col("_v").cast("double") / 1000.0).alias("budget_value"))


def rep_emails(t: DomainTables) -> DataFrame:
    """Rep e-mail by rep code as a scalar lookup: at most one row per
    code (the smallest e-mail if the table ever repeats a code), so the
    left join can never multiply client rows."""
    return (t.sales_reps.groupBy(F.col("code").alias("_rep"))
            .agg(F.min("email").alias("sales_rep_email")))


def client_view(t: DomainTables, base_ts=BASE_TS, budget_overrides=None, order_overrides=None) -> DataFrame:
    """V1: 27-column client master view."""
    bo = BUDGET_VALUE_OVERRIDES if budget_overrides is None else budget_overrides
    oo = ORDER_VALUE_OVERRIDES if order_overrides is None else order_overrides
    base = client_base(t)
    reps = rep_emails(t)
    fa = latest_observation(t)
    j = (base.join(min_industry(t), KEYS, "left")
             .join(fa, "client_code", "left")
             .join(budget_value(t, base_ts), KEYS, "left")
             .join(order_measures(t, base_ts), KEYS, "left")
             .join(reps, base.sales_rep == reps._rep, "left"))
    return j.select(
        "id", "client_code", "branch_code", "company_name", "taxid", "sales_rep", "country", "state", "city",
        "city_code", "address_zipcode", "address_street", "address_number", "address_district",
        "address_complement", "email", "tax_registration", "phone", "id_crm", "integrate_crm", "industry",
        "financial_analysis",
        with_override(F.col("client_code"), F.col("budget_value"), bo).alias("budget_value"),
        F.coalesce("has_order", F.lit("N")).alias("has_order"),
        with_override(F.col("client_code"), F.col("order_value"), oo).alias("order_value"),
        F.coalesce("has_retention", F.lit("N")).alias("has_retention"),
        "sales_rep_email",
    )


# ---------------------------------------------------------------------------
# Change views
# ---------------------------------------------------------------------------


def _lead_side(df: DataFrame, id_col: str, name_col: str) -> DataFrame:
    u = F.upper
    return df.select(
        F.col(id_col).alias("id"), u(F.col(name_col)).alias("name"), pad_taxid(F.col("taxid")).alias("taxid"),
        u("address_street").alias("address_street"), F.col("address_zipcode"), F.col("address_number"),
        u("address_complement").alias("address_complement"), u("address_district").alias("address_district"),
        u("city").alias("city"), u("state").alias("state"), F.col("sales_rep"), F.col("client_code"),
        F.col("tax_registration"), F.col("financial_analysis"))


def crm_lead_rows(t: DomainTables, synced_only_stage: bool = True) -> DataFrame:
    """A: CRM leads in the synced stages, normalised."""
    leads = t.leads.where(F.col("stage").isin(*SYNCED_STAGES)) if synced_only_stage else t.leads
    return _lead_side(leads, "id", "name")


def erp_lead_rows(t: DomainTables, synced_only: bool = False) -> DataFrame:
    """B: linked ERP clients whose CRM id exists among the leads, normalised.

    ``synced_only`` (Q21) also restricts them to leads in the synced stages.
    """
    cv = client_base(t).join(latest_observation(t), "client_code", "left")
    leads = t.leads
    if synced_only:
        leads = leads.where(F.col("stage").isin(*SYNCED_STAGES))
    cv = cv.where(F.col("id_crm").isNotNull()).join(leads.select(F.col("id").alias("_lid")),
                                                     F.col("id_crm") == F.col("_lid"), "left_semi")
    return _lead_side(cv, "id_crm", "company_name")


def lead_diff(t: DomainTables, synced_only: bool = False) -> DataFrame:
    """ERP-side lead rows that differ from the CRM copy (B − A)."""
    return chained_diff(crm_lead_rows(t), erp_lead_rows(t, synced_only))


def insert_candidates(t: DomainTables) -> DataFrame:
    """Clients flagged for integration that have no CRM id yet."""
    cv = client_base(t).join(min_industry(t), KEYS, "left")
    return cv.where((F.col("integrate_crm") == "Y") & F.col("id_crm").isNull()).select(
        F.col("company_name").alias("name"), "taxid", F.col("address_street").alias("address"),
        F.col("address_district").alias("district"), F.col("address_zipcode").alias("zipcode"),
        F.col("address_number").alias("number"), "city", "phone", F.col("address_complement").alias("complement"),
        "state", "country", "industry", "sales_rep", "client_code", "tax_registration")


def contact_view(t: DomainTables) -> DataFrame:
    """V2: ERP contacts with their client's tax id; job title falls back to the
    title table (J2 inner, J3 left outer, F4)."""
    c = t.contact
    f = t.branches.select(F.col("client").alias("_fc"), F.col("code").alias("_fb"), F.col("taxid").alias("client_taxid"))
    g = t.contact_job_titles
    j = (c.join(f, (c.branch_client == f._fc) & (c.branch_code == f._fb))
          .join(g, c.job_title_code == g.job_title_code, "left"))
    return j.select(c.code.alias("id"), c.name, c.email, c.phone,
                    F.coalesce(c.job_title_desc, g.title).alias("job_title"), "client_taxid", c.id_crm,
                    c.is_primary)


def _contact_side(df: DataFrame) -> DataFrame:
    u = F.upper
    return df.select(F.col("id"), u("name").alias("name"), u("email").alias("email"), F.col("phone"),
                     u("job_title").alias("job_title"), u("is_primary").alias("is_primary"), F.col("lead_id"))


def contact_diff(t: DomainTables) -> DataFrame:
    """ERP contacts (linked, known to the CRM) differing from the CRM copy."""
    crm_c = t.contacts
    leads = t.leads.select(F.col("id").alias("lead_id"), F.col("client_code").alias("_lcc"))
    # CONTACTS.CLIENT_CODE is text, LEADS.CLIENT_CODE a number: explicit cast.
    a = (crm_c.join(leads, crm_c.client_code.cast("bigint") == leads._lcc)
         .withColumn("is_primary", F.when(F.col("is_primary"), "S").otherwise("N")))
    a = _contact_side(a)
    con = contact_view(t).where(F.col("id_crm").isNotNull())
    con = con.join(crm_c.select(F.col("id").alias("_cid")), con.id_crm == F.col("_cid"), "left_semi")
    cli = client_base(t).select(F.col("taxid").alias("_tax"), F.col("id_crm").alias("lead_id"))
    b = con.join(cli, con.client_taxid == cli._tax).drop("id").withColumnRenamed("id_crm", "id")
    return chained_diff(a, _contact_side(b))


def budget_changes(t: DomainTables, base_ts=BASE_TS) -> DataFrame:
    """V6: leads whose ERP budget value is set and differs (NULL CRM value = -1)."""
    l = t.leads.select("id", F.col("budget_value").alias("_lb"), F.col("taxid"))
    e = (client_base(t).select("client_code", "branch_code", "id_crm")
         .join(budget_value(t, base_ts), KEYS, "left")
         .select("id_crm", with_override(F.col("client_code"), F.col("budget_value"),
                                         BUDGET_VALUE_OVERRIDES).alias("budget_value")))
    j = l.join(e, l.id == e.id_crm)
    return (j.where(F.col("budget_value").isNotNull()
                    & (F.coalesce(F.col("_lb").cast("double"), F.lit(-1.0)) != F.col("budget_value")))
            .select("id", "budget_value", "taxid"))


def value_changes(t: DomainTables, base_ts=BASE_TS) -> DataFrame:
    """V6 and V7 from one frame of both values per client: per lead the new budget and order value, NULL where the view
    has no row for the lead."""
    from ..schemas import ACTIVATION_STAGE
    l = t.leads.select("id", "stage", F.col("budget_value").cast("double").alias("_lb"), F.col("order_value").cast("double").alias("_lo"))
    e = (client_base(t).select("client_code", "branch_code", "id_crm")
         .join(budget_value(t, base_ts), KEYS, "left").join(order_value(t, base_ts), KEYS, "left")
         .select("id_crm", with_override(F.col("client_code"), F.col("budget_value"), BUDGET_VALUE_OVERRIDES).alias("bv"),
                 with_override(F.col("client_code"), F.col("order_value"), ORDER_VALUE_OVERRIDES).alias("ov")))
    budget = F.col("bv").isNotNull() & (F.coalesce("_lb", F.lit(-1.0)) != F.col("bv"))
    sold = F.col("bv").isNotNull() & (F.col("stage") != ACTIVATION_STAGE) & (F.coalesce("_lo", F.lit(-1.0)) != F.col("ov"))
    return l.join(e, l.id == e.id_crm).select("id", F.when(budget, F.col("bv")).alias("budget_value"),
                                              F.when(sold, F.col("ov")).alias("order_value"))


def sold_changes(t: DomainTables, base_ts=BASE_TS) -> DataFrame:
    """V7: leads not in Activation whose order value differs; like the source
    view it requires the *budget* value to be set (Q11)."""
    from ..schemas import ACTIVATION_STAGE
    l = t.leads.select("id", "stage", F.col("order_value").alias("_lo"))
    cb = client_base(t).select("client_code", "branch_code", "id_crm", "sales_rep")
    reps = rep_emails(t)
    e = (cb.join(budget_value(t, base_ts), KEYS, "left").join(order_value(t, base_ts), KEYS, "left")
         .join(reps, F.col("sales_rep") == F.col("_rep"), "left")
         .select("id_crm", "sales_rep_email",
                 with_override(F.col("client_code"), F.col("budget_value"), BUDGET_VALUE_OVERRIDES).alias("bv"),
                 with_override(F.col("client_code"), F.col("order_value"), ORDER_VALUE_OVERRIDES).alias("order_value")))
    j = l.join(e, l.id == e.id_crm)
    return (j.where(F.col("bv").isNotNull() & (F.col("stage") != ACTIVATION_STAGE)
                    & (F.coalesce(F.col("_lo").cast("double"), F.lit(-1.0)) != F.col("order_value")))
            .select("id", "order_value", "sales_rep_email"))
