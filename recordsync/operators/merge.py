"""Merges and cascades as snapshot operators.

Parquet tables take no UPDATE/MERGE, and a path being read must not be
overwritten, so every DML of the source becomes ``(target, changes) -> new
target`` (written as a new version by the caller).  One primitive,
``merge_snapshot``, is a full outer join on the key plus per-column
``when``; all operators are idempotent: applying the same changes twice gives
the same snapshot, so a retried micro-batch or a lost executor is harmless.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_key, stage_ordinal
from .contacts import contact_merge  # noqa: F401
from .joins import last_per_key


def merge_snapshot(target: DataFrame, changes: DataFrame, keys: list[str], update_cols: list[str] | None = None,
                   delete_col: str | None = None, insert: bool = True) -> DataFrame:
    """M1: upsert ``changes`` into ``target`` on ``keys``.

    Matched rows take the change's value for ``update_cols`` (default: all
    non-key columns the change carries); unmatched changes are inserted
    (``insert=False`` = update only); when ``delete_col`` is true on a change
    the matched row is dropped.  ``changes`` must be unique on ``keys``: a
    repeated key raises an error, as it has no defined result.
    """
    cols = target.columns
    upd = [c for c in (update_cols or [c for c in changes.columns if c in cols and c not in keys])]
    ch_cols = [c for c in changes.columns if c in cols or c == delete_col]
    rest = F.struct(*[F.col(c).alias(f"_n_{c}") for c in ch_cols if c not in keys], F.lit(True).alias("_in_c"))
    once = changes.groupBy(*keys).agg(F.first(rest).alias("_r"), F.count(F.lit(1)).alias("_times"))  # the join's partitioning
    twice = F.raise_error(F.concat(F.lit("merge_snapshot: a key has several changes: "), F.to_json(F.struct(*keys))))
    once = once.withColumn("_r", F.when(F.col("_times") == 1, F.col("_r")).otherwise(twice.cast(once.schema["_r"].dataType)))
    ch = once.select(*keys, "_r.*")
    t = target.withColumn("_in_t", F.lit(True))
    j = t.join(ch, keys, "full_outer")
    out = []
    for c in cols:
        if c in keys:
            out.append(F.col(c))
        elif c in upd:
            out.append(F.when(F.col("_in_c").isNotNull(), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c))
        elif f"_n_{c}" in j.columns:
            out.append(F.when(F.col("_in_t").isNotNull(), F.col(c)).otherwise(F.col(f"_n_{c}")).alias(c))
        else:
            out.append(F.col(c))
    keep = F.lit(True)
    if not insert:
        keep = F.col("_in_t").isNotNull()
    if delete_col:
        keep = keep & ~F.coalesce(F.col(f"_n_{delete_col}"), F.lit(False))
    return j.where(keep).select(*out)


def partial_update(target: DataFrame, docs: DataFrame, key: str, fields: dict[str, tuple[Column, Column]],
                   order_col: str) -> DataFrame:
    """M2: apply documents that carry only some fields.

    Documents are applied in ``order_col`` order by the source, one at a
    time, so a field ends with the value of the latest document *containing*
    it (present-but-null included).  Per key and field that is one
    ``max_by(value, order if present)`` in a single grouped aggregate
    (partial aggregation first, so a hot key costs one row per task).
    ``fields`` maps a target column to (new value, presence flag); presence
    comes from the raw JSON keys, so "absent" and "present but null" differ.

    When the target carries ``_o_<field>`` columns (the order of the value
    it holds, as the streaming snapshot does), a document only wins if it is
    newer, so micro-batches may arrive in any order and replays are no-ops.
    """
    sel = [F.col(key), F.col(order_col).alias("_ord")]
    for c, (val, present) in fields.items():
        sel += [val.alias(f"_v_{c}"), present.alias(f"_p_{c}")]
    d = docs.select(*sel)
    aggs = []
    for c in fields:
        aggs += [F.max_by(F.col(f"_v_{c}"), F.when(F.col(f"_p_{c}"), F.col("_ord"))).alias(f"_v_{c}"),
                 F.max(F.when(F.col(f"_p_{c}"), F.col("_ord"))).alias(f"_n_{c}")]
    d = d.groupBy(key).agg(*aggs)
    j = target.join(d, key, "left")
    out = []
    for c in target.columns:
        if c in fields:
            win = F.col(f"_n_{c}").isNotNull()
            if f"_o_{c}" in target.columns:
                win = win & (F.col(f"_o_{c}").isNull() | (F.col(f"_n_{c}") > F.col(f"_o_{c}")))
            out.append(F.when(win, F.col(f"_v_{c}").cast(target.schema[c].dataType)).otherwise(F.col(c)).alias(c))
        elif c.startswith("_o_") and c[3:] in fields:
            n = F.col(f"_n_{c[3:]}")
            out.append(F.when(n.isNotNull() & (F.col(c).isNull() | (n > F.col(c))), n).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def route_by_stage(docs: DataFrame, stage_col: str, budget_stage: str, activation_stage: str) -> DataFrame:
    """M4: action per document: budget stage -> insert lead (+ contacts),
    activation -> stage update, anything else -> ignore."""
    s = F.col(stage_col)
    return docs.withColumn("action", F.when(s == budget_stage, "insert_lead")
                           .when(s == activation_stage, "update_stage").otherwise("ignore"))


def contact_route(incoming: DataFrame, target: DataFrame, email_col: str = "email",
                  target_email: str = "email") -> DataFrame:
    """Count target contacts per lower(e-mail) (pre-aggregated, one row
    per address) and route: 0 -> insert, 1 -> update, more -> ambiguous
    (quarantined, Q16), no e-mail -> reject."""
    counts = (target.where(F.col(target_email).isNotNull())
              .groupBy(F.lower(F.col(target_email)).alias("_em")).agg(F.count(F.lit(1)).alias("matches")))
    j = incoming.join(counts, F.lower(F.col(email_col)) == F.col("_em"), "left").drop("_em")
    m = F.coalesce(F.col("matches"), F.lit(0))
    return (j.withColumn("matches", m.cast("bigint"))
            .withColumn("action", F.when(F.col(email_col).isNull(), "reject_no_email")
                        .when(m == 0, "insert").when(m == 1, "update").otherwise("ambiguous")))


def write_back(target: DataFrame, pairs: DataFrame, target_key: Column, pair_key: str,
               sets: dict[str, Column]) -> DataFrame:
    """M7/M8: ``UPDATE target SET ... WHERE key = pair.key`` as a left join.

    Pair columns are visible to ``sets`` as ``_p_<name>``; pairs are made
    unique on the key first (the highest CRM id wins)."""
    p = last_per_key(pairs, [pair_key], "id_crm")
    p = p.select(F.col(pair_key).alias("_pk"), *[F.col(c).alias(f"_p_{c}") for c in p.columns if c != pair_key],
                 F.lit(True).alias("_hit"))
    j = target.withColumn("_tk", target_key).join(p, F.col("_tk") == F.col("_pk"), "left")
    out = [F.when(F.col("_hit").isNotNull(), sets[c]).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c)
           if c in sets else F.col(c) for c in target.columns]
    return j.select(*out)


def insert_ignore(target: DataFrame, rows: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Rows to append, skipping keys already present instead of failing;
    of rows with one key the first by ``order`` (default: all other columns) is
    taken."""
    from .joins import first_per_key
    others = [c for c in rows.columns if c not in keys]
    once = first_per_key(rows, keys, order or others) if others else rows.distinct()
    return once.select(*rows.columns).join(target.select(*keys), keys, "left_anti")


def next_sequence(history: DataFrame, new_rows: DataFrame, key: str, seq_col: str = "sequence",
                  order: str | None = None) -> DataFrame:
    """``NVL(max(seq), 0) + n`` per key; several new rows of one key
    get consecutive numbers in ``order``.

    Numbering inside a key does not use a window over the whole key (a key
    with a third of the rows would land in one task): rows are range
    partitioned on (key, order), each partition numbers its own rows of the
    key, and a per-(key, partition) count table gives each partition its
    offset within the key.  The numbered rows are checkpointed before both
    uses, so that counts and rows agree on the partitions.
    """
    from pyspark.sql import Window

    from ..session import cut_lineage
    order = order or key
    mx = history.groupBy(key).agg(F.max(seq_col).alias("_max"))
    parts = new_rows.repartitionByRange(key, order).withColumn("_pid", F.spark_partition_id())
    local = cut_lineage(parts.withColumn("_pos", F.row_number().over(Window.partitionBy("_pid", key).orderBy(order))))
    counts = local.groupBy(key, "_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    j = local.join(offs.select(key, "_pid", "_off"), [key, "_pid"]).join(mx, key, "left")
    seq = F.coalesce(F.col("_max"), F.lit(0)) + F.col("_off") + F.col("_pos")
    return j.withColumn(seq_col, seq.cast("bigint")).drop("_max", "_pid", "_pos", "_off")


def stage_regression(leads: DataFrame, crm_state: DataFrame, stages: list[str], alias_of: dict[str, str],
                     lead_stage_col: str = "stage", crm_stage_col: str = "stage", lead_key: str = "taxid",
                     crm_key: str = "cnpj") -> DataFrame:
    """Leads to delete, with a reason: missing from the CRM
    (or no CRM stage), or the CRM stage is earlier than the stored one; an
    unknown stage is quarantined instead of aborting (Q14).  The current CRM
    stage is looked up by tax id (``ltrim(lpad(.., 14, '0'))`` on both sides),
    as the source does; one CRM row per tax id (the lowest CRM id).  A stored
    tax id longer than 14 characters can't be looked up: its lead comes with
    the reason ``taxid_too_long`` and is to be looked at, not deleted."""
    from ..functions.text import taxid_key, taxid_too_long
    from .joins import first_per_key
    m = F.create_map(*[x for a, c in alias_of.items() for x in (F.lit(a), F.lit(c))])
    cur = crm_state.where(F.col(crm_key).isNotNull()).select(
        taxid_key(F.col(crm_key)).alias("_ck"), F.col("id").alias("_cid"), F.col(crm_stage_col).alias("_crm_stage"))
    cur = first_per_key(cur, ["_ck"], ["_cid"])
    j = leads.join(cur, taxid_key(F.col(lead_key)) == F.col("_ck"), "left")
    stored = F.coalesce(F.try_element_at(m, F.col(lead_stage_col)), F.col(lead_stage_col))
    o_now = stage_ordinal(F.col("_crm_stage"), stages)
    o_old = stage_ordinal(stored, stages)
    reason = (F.when(taxid_too_long(lead_key), "taxid_too_long")
              .when(F.col("_cid").isNull() | F.col("_crm_stage").isNull(), "missing_in_crm")
              .when((o_now == 0) | (o_old == 0), "unknown_stage")
              .when(o_now < o_old, "stage_regressed"))
    return (j.withColumn("reason", reason).where(F.col("reason").isNotNull())
            .select("id", F.col(lead_stage_col).alias("stored_stage"), F.col("_crm_stage").alias("crm_stage"),
                    "reason"))


def replace_product(current: DataFrame, replacements: DataFrame, keys: list[str]) -> DataFrame:
    """Remove the (lead, product) rows being replaced, then add the new
    ones (anti join + union; re-applying gives the same rows)."""
    return (current.join(replacements.select(*keys), keys, "left_anti")
            .unionByName(replacements.select(*current.columns)))


def resolve_city(df: DataFrame, city_col: str, state_col: str, cities: DataFrame, states: DataFrame) -> DataFrame:
    """City code, state code and country by case/accent-insensitive
    names; several matches -> the smallest city code (deterministic)."""
    ref = (cities.join(states, cities.state_code == states.code)
           .select(normalize_key(F.col("city_name")).alias("_kc"), normalize_key(F.col("name")).alias("_ks"),
                   F.col("id").alias("city_code"), F.col("state_code"), F.col("country_code")))
    ref = ref.groupBy("_kc", "_ks").agg(F.min(F.struct("city_code", "state_code", "country_code")).alias("_r"))
    j = df.withColumn("_kc", normalize_key(F.col(city_col))).withColumn("_ks", normalize_key(F.col(state_col)))
    return (j.join(ref, ["_kc", "_ks"], "left")
            .select(*df.columns, F.col("_r.city_code").alias("city_code"), F.col("_r.state_code").alias("state_code"),
                    F.col("_r.country_code").alias("country_code")))


def contact_upsert(target: DataFrame, incoming: DataFrame, clients: DataFrame) -> DataFrame:
    """M5: CRM contacts into the CRM-copy contact table, routed by e-mail count.

    ``target`` (id, name, email, phone, job_title, client_code, is_primary);
    ``incoming`` (id_crm, name, email, phone, job_title, lead_id, is_primary);
    ``clients`` (lead_id, client_code) resolves the client of the contact's
    lead.  Contacts without e-mail or client are left out (see the
    quarantine key).  With one target row for the (lower-case) e-mail the
    row whose id is the contact's id is updated; with none the first new
    contact per e-mail is inserted (the source handled documents one by one,
    so later ones found the e-mail already present); with more nothing
    happens (Q16).  Phone is cut to 13 characters, job title to 30.
    """
    from .joins import first_per_key
    inc = (incoming.join(clients, "lead_id", "left")
           .where(F.col("email").isNotNull() & F.col("client_code").isNotNull()))
    routed = contact_route(inc, target)
    shaped = routed.select(
        F.col("id_crm").alias("id"), "name", "email", F.substring("phone", 1, 13).alias("phone"),
        F.substring("job_title", 1, 30).alias("job_title"), F.col("client_code").cast("string").alias("client_code"),
        "is_primary", "action")
    upd = shaped.where(F.col("action") == "update").drop("action")
    upd = first_per_key(upd, ["id"], [c for c in upd.columns if c != "id"])
    new = shaped.where(F.col("action") == "insert").drop("action").withColumn("_em", F.lower("email"))
    new = first_per_key(new, ["_em"], ["id"]).drop("_em")
    updated = merge_snapshot(target, upd, ["id"], insert=False)
    return updated.unionByName(insert_ignore(target, new, ["id"]).select(*target.columns))


def converted_lead_rows(docs: DataFrame, add_info: DataFrame, budget_stage_alias: str, raw_col: str = "raw",
                        id_col: str = "lead_id", order: str = "received_at", tie: str = "doc_id") -> DataFrame:
    """M4 (insert branch) + J9: lead rows for documents whose lead reached
    the budget stage.

    The latest such document per lead is used; address data the document
    lacks comes from ``add_info`` (CRM export: phone1, number, complement,
    district, city, state) in one left join.  Shaping follows the source:
    company cut to 40; street = text before ',' then before '-', cut to 50;
    zip without punctuation; number parsed, else 0 (Q19); custom fields:
    the last entry of an id wins; registration '99'/'0'/missing -> '99'.
    """
    from ..functions.text import strip_punct
    from .joins import last_per_key
    raw = F.col(raw_col)
    d = last_per_key(docs.select(id_col, raw_col, order, tie), [id_col], order, tie)
    cfs = F.from_json(F.get_json_object(raw, "$.Lead.CustomFields"), "array<struct<id:string,value:string>>")

    def last(fid):
        return F.try_element_at(F.filter(cfs, lambda x: x["id"] == F.lit(fid)), F.lit(-1))["value"]
    a = add_info.select(F.col("id").alias("_aid"), "phone1", "number", "complement", "district", "city", "state")
    j = d.join(a, F.col(id_col) == F.col("_aid"), "left")
    maps = F.get_json_object(raw, "$.Lead.Address.Address_Maps")
    reg = last("_inscricaoestadual")
    return j.select(
        F.col(id_col).alias("id"), F.get_json_object(raw, "$.Lead.CpfCnpj").alias("taxid"),
        F.substring(F.get_json_object(raw, "$.Lead.Company"), 1, 40).alias("name"),
        F.lit(budget_stage_alias).alias("stage"),
        F.get_json_object(raw, "$.Lead.Industry.value").alias("industry"),
        F.get_json_object(raw, "$.Lead.Origin.value").alias("source"),
        F.col("phone1").alias("phone"),
        F.substring(F.substring_index(F.substring_index(maps, ",", 1), "-", 1), 1, 50).alias("address_street"),
        strip_punct(F.get_json_object(raw, "$.Lead.Address.ZipCode")).alias("address_zipcode"),
        F.coalesce(F.col("number").try_cast("int"), F.lit(0)).alias("address_number"),
        F.col("complement").alias("address_complement"), F.col("district").alias("address_district"),
        "city", "state", last("_cod.gestores").try_cast("bigint").alias("sales_rep"),
        F.when(reg.isNull() | reg.isin("99", "0"), F.lit("99")).otherwise(reg).alias("tax_registration"),
        last("_analisefinanceira").alias("financial_analysis"))
