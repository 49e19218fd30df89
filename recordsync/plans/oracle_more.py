"""Oracle SQL (DuckDB) for the operator keys beyond the views.

Each body states its rule over the stand-ins or over the views of ``oracle_sql``,
mostly by OR joins, sub-queries, NOT EXISTS and CASE.
"""

from __future__ import annotations

from ..schemas import DIFF_FIELDS, LEAD_COLUMNS, LEAD_DIFF_COLS
from .oracle_sql import ORACLE, STANDINS, initcap2

SYNCED = "('Development/Budget', 'Activation', 'Retention/Expansion')"
SYNCED_CANON = "('Desenvolvimento/Orçamento', 'Ativação', 'Retenção/Expansão')"


def strip(x: str) -> str:
    return f"replace(replace({x}, '.', ''), '-', '')"


def cf(arr: str, fid: str) -> str:
    return f"list_filter({arr}, lambda x: x.id = '{fid}')[-1].value"


def drop_nulls(js: str) -> str:
    """to_json keeps null members; the payload omits them."""
    return (f"regexp_replace(regexp_replace(regexp_replace({js}, '\"[A-Za-z_]+\":null,', '', 'g'), "
            f"',\"[A-Za-z_]+\":null', '', 'g'), '\"[A-Za-z_]+\":null', '', 'g')")


def reg_to_erp(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR upper({x}) = 'ISENTO' OR {x} IN ('99', '0') THEN '99' ELSE {strip(x)} END"


NULL_MARK = "chr(0)"


def fp(cols: list[str]) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), {NULL_MARK})" for c in cols)
    return f"md5(concat_ws('|', {parts}))"


BRANCH_COLS = ["client", "code", "description", "taxid", "sales_rep", "city", "zipcode", "address", "number",
               "district", "complement", "email", "tax_registration", "phone", "id_crm", "integrate_crm"]

STANDINS.update({
    "rep_options": """SELECT DISTINCT CAST(f.value AS BIGINT) AS code
        FROM (SELECT unnest(CustomFields) AS f FROM lead_docs) WHERE f.id = '_cod.gestores'""",
    "custom_fields_t": """SELECT leadId AS lead_id,
        arg_max(value, pos) FILTER (WHERE id = '_cod.gestores') AS sales_rep,
        arg_max(value, pos) FILTER (WHERE id = '_inscricaoestadual') AS tax_registration,
        arg_max(value, pos) FILTER (WHERE id = '_analisefinanceira') AS financial_analysis,
        arg_max(value, pos) FILTER (WHERE id = '_cod.cliente') AS client_code
        FROM custom_field_rows GROUP BY leadId""",
    "staged_leads": f"""SELECT e.id, e.lead AS name, m.alias AS stage, e.cnpj AS taxid, e.industry.value AS industry,
        e.source.value AS source, {strip('e.phone1')} AS phone, e.street AS address_street,
        {strip('e.cep')} AS address_zipcode, coalesce(TRY_CAST(e.number AS INTEGER), 0) AS address_number,
        e.complement AS address_complement, e.district AS address_district, e.city, e.state,
        TRY_CAST(cf.sales_rep AS BIGINT) AS sales_rep, {reg_to_erp('cf.tax_registration')} AS tax_registration,
        cf.financial_analysis
        FROM crm_export e JOIN stage_table m ON replace(e.stage, chr(160), ' ') = m.canonical
        LEFT JOIN custom_fields_t cf ON cf.lead_id = e.id
        WHERE m.alias IN {SYNCED} AND e.id <> 12345678""",
    "validated": f"""SELECT e.*, CASE WHEN replace(e.stage, chr(160), ' ') IN {SYNCED_CANON} THEN concat_ws(',',
            CASE WHEN e.id IS NULL OR e.id = 0 THEN 'id' END,
            CASE WHEN e.lead IS NULL OR e.lead = '' THEN 'lead' END,
            CASE WHEN e.cnpj IS NULL OR e.cnpj = '' THEN 'cnpj' END,
            CASE WHEN e.industry.value IS NULL OR e.industry.value = '' THEN 'industry.value' END,
            CASE WHEN e.source.value IS NULL OR e.source.value = '' THEN 'source.value' END,
            CASE WHEN e.street IS NULL OR e.street = '' THEN 'street' END,
            CASE WHEN e.cep IS NULL OR e.cep = '' THEN 'cep' END,
            CASE WHEN e.number IS NULL OR e.number = '' THEN 'number' END,
            CASE WHEN e.district IS NULL OR e.district = '' THEN 'district' END,
            CASE WHEN e.city IS NULL OR e.city = '' THEN 'city' END,
            CASE WHEN e.state IS NULL OR e.state = '' THEN 'state' END) ELSE '' END AS failed
        FROM crm_export e LEFT JOIN custom_fields_t cf ON cf.lead_id = e.id""",
    "city_ref": """SELECT upper(strip_accents(c.city_name)) AS kc, upper(strip_accents(s.name)) AS ks,
        min(c.id) AS city_code, min(c.state_code) AS state_code, min(c.country_code) AS country_code
        FROM cities c JOIN states s ON c.state_code = s.code GROUP BY 1, 2""",
    "insert_cands": """SELECT company_name AS name, taxid, address_street AS address, address_district AS district,
        address_zipcode AS zipcode, address_number AS number, city, phone, address_complement AS complement, state,
        country, industry, sales_rep, client_code, tax_registration
        FROM vw_base b LEFT JOIN vw_industry i USING (client_code, branch_code)
        WHERE integrate_crm = 'Y' AND id_crm IS NULL""",
    "lead_diff_rows": "SELECT * FROM lead_b EXCEPT SELECT * FROM lead_a",
    "latest_docs": """SELECT * FROM webhook_docs
        QUALIFY row_number() OVER (PARTITION BY lead_id ORDER BY received_at DESC, doc_id DESC) = 1""",
    "field_diff_rows": f"""SELECT s.*, t.id AS tgt_id, concat_ws(',', {', '.join(f"CASE WHEN s.{c} <> t.{c} THEN '{c}' END" for c in DIFF_FIELDS)}) AS changed
        FROM staged_leads s LEFT JOIN leads t ON s.id = t.id
        WHERE t.id IS NULL OR {' OR '.join(f's.{c} <> t.{c}' for c in DIFF_FIELDS)}""",
    "arrivals": """SELECT n.*, (SELECT max(client) FROM branches) + row_number() OVER (ORDER BY tk) AS client,
            upper(name) AS description, coalesce(upper(address_street), 'X') AS address,
            coalesce(upper(address_district), 'X') AS district, address_zipcode AS zipcode,
            coalesce(r.city_code, 10000)::BIGINT AS city_of, coalesce(r.state_code::VARCHAR, 'XX') AS state_of,
            coalesce(r.country_code, 'US') AS country
        FROM (SELECT *, CASE WHEN length(taxid) <= 14 THEN ltrim(lpad(taxid, 14, '0')) END AS tk FROM staged_leads
              QUALIFY row_number() OVER (PARTITION BY tk ORDER BY id) = 1) n
        LEFT JOIN city_ref r ON upper(strip_accents(n.city)) = r.kc AND upper(strip_accents(n.state)) = r.ks
        WHERE tk IS NOT NULL AND tk NOT IN (SELECT ltrim(lpad(taxid, 14, '0')) FROM branches WHERE length(taxid) <= 14)""",
    "matched": """SELECT s.*, cv.client_code AS erp_client_code, cv.branch_code AS erp_branch_code,
        cv.company_name AS erp_company_name, cv.address_street AS erp_address_street,
        cv.address_number AS erp_address_number, cv.address_complement AS erp_address_complement,
        cv.address_district AS erp_address_district, cv.city_code AS erp_city_code,
        cv.address_zipcode AS erp_address_zipcode, cv.sales_rep AS erp_sales_rep, cv.phone AS erp_phone,
        cv.industry AS erp_industry, cv.integrate_crm AS erp_integrate_crm, cv.id_crm AS erp_id_crm,
        cv.tax_registration AS erp_tax_registration
        FROM staged_leads s JOIN (SELECT b.*, i.industry FROM vw_base b LEFT JOIN vw_industry i USING (client_code, branch_code)) cv
          ON CASE WHEN length(s.taxid) <= 14 THEN ltrim(lpad(s.taxid, 14, '0')) END = CASE WHEN length(cv.taxid) <= 14 THEN ltrim(lpad(cv.taxid, 14, '0')) END""",
    "route": """SELECT i.*, coalesce(c.cnt, 0)::BIGINT AS matches,
        CASE WHEN i.email IS NULL THEN 'reject_no_email' WHEN coalesce(c.cnt, 0) = 0 THEN 'insert'
             WHEN c.cnt = 1 THEN 'update' ELSE 'ambiguous' END AS action
        FROM incoming_contacts i LEFT JOIN (SELECT lower(email) AS em, count(*) AS cnt FROM contacts
                                            WHERE email IS NOT NULL GROUP BY 1) c ON lower(i.email) = c.em""",
    "budget_changes_rows": ORACLE["budget_changes"],
    "sold_changes_rows": ORACLE["sold_changes"],
})

ORACLE.update({
    "normalize_text": """SELECT doc_id, md5(upper(replace(strip_accents(text), 'ß', 'ss'))) AS key_md5,
        length(upper(replace(strip_accents(text), 'ß', 'ss')))::BIGINT AS key_len, lower(strip_accents(lang)) AS lang
        FROM documents""",
    "initcap_words": f"SELECT p_partkey, {initcap2(chr(40) + 'p_type || ' + chr(39) + '-' + chr(39) + ' || p_name' + chr(41))} AS title FROM part",
    "client_key": """SELECT client, coalesce(client::VARCHAR, '') || '-' || coalesce(code::VARCHAR, '') || '/'
        || coalesce(complement, '') AS client_key FROM branches""",
    "strip_punct": f"SELECT id, {strip('phone1')} AS phone, {strip('cep')} AS zipcode FROM crm_export",
    "slug": """SELECT p_partkey, replace(replace(replace(replace(p_brand || ' / ' || p_type || ', ' || p_name || '.',
        ' ', '_'), '/', ''), '.', ''), ',', '') AS slug FROM part""",
    "field_truncate": """SELECT p_partkey, substr(p_name, 1, 40) AS name, substr(p_type, 1, 13) AS short,
        substr(p_name, 1, 30) AS title FROM part""",
    "street_token": """SELECT p_partkey, regexp_split_to_array(trim(p_name), '\\s+')[1] AS first_word,
        trim(split_part(split_part(p_type || ' - ' || p_brand || ', ' || p_name, ',', 1), '-', 1)) AS street FROM part""",
    "int_part": "SELECT l_orderkey, l_linenumber, split_part(l_quantity::VARCHAR, '.', 1) AS qty_int FROM lineitem",
    "house_number": """SELECT id, coalesce(TRY_CAST(number AS INTEGER), 0) AS number,
        coalesce(coalesce(TRY_CAST(number AS INTEGER), 0)::VARCHAR, 'SN') AS number_out FROM crm_export""",
    "registration_code": f"""SELECT id, raw, to_erp, CASE WHEN to_erp IS NULL OR to_erp IN ('99', '0') THEN 'ISENTO' ELSE to_erp END AS to_crm
        FROM (SELECT id, raw, {reg_to_erp('raw')} AS to_erp FROM (SELECT id, {cf('CustomFields', '_inscricaoestadual')} AS raw FROM lead_docs))""",
    "flag_map": """SELECT id, sn AS is_primary, CASE WHEN upper(sn) IN ('S', 'Y') THEN true WHEN upper(sn) = 'N' THEN false END AS is_primary_bool
        FROM (SELECT id, CASE lower(mainContact) WHEN 'true' THEN 'S' WHEN 'false' THEN 'N' END AS sn FROM crm_contacts)""",
    "default_fill": """SELECT id, coalesce(address_complement, '') AS address_complement,
        coalesce(financial_analysis, 'Vazio.') AS financial_analysis, coalesce(state, 'XX') AS state,
        coalesce(phone, '5500000000') AS phone FROM leads""",
    "price_fallback": """SELECT bid_bdg_number, bid_item, CAST(bid_quantity AS DOUBLE) AS bid_quantity, client_code,
        CAST(CASE WHEN coalesce(negotiated_price, 0) = 0 THEN price ELSE negotiated_price END AS DOUBLE) AS price
        FROM budget_item_quant_delivery""",
    "row_fingerprint": f"SELECT client, {fp(BRANCH_COLS)} AS fingerprint FROM branches",
    "stage_filter": f"SELECT id, stage FROM leads WHERE stage IN {SYNCED}",
    "exclusion_anti": """SELECT id, lead FROM crm_export WHERE id NOT IN (12345678)
        AND (lead IS NULL OR lead NOT IN ('Customer#000000007'))""",
    "rename_map": """SELECT id, name, taxid, industry, source, phone, address_street, address_zipcode, address_number,
        address_complement, address_district, city, state, sales_rep, tax_registration, client_code,
        CAST(budget_value AS DOUBLE) AS budget_value, CAST(order_value AS DOUBLE) AS order_value, financial_analysis
        FROM leads""",
    "semi_restrict": "SELECT id, client_code, id_crm FROM vw_base WHERE id_crm IS NOT NULL AND id_crm IN (SELECT id FROM leads)",
    "lead_enrich": """SELECT e.id, e.lead, e.cnpj, CAST(cf.sales_rep AS BIGINT) AS sales_rep, cf.tax_registration,
        cf.financial_analysis, CAST(cf.client_code AS BIGINT) AS client_code
        FROM crm_export e LEFT JOIN custom_fields_t cf ON e.id = cf.lead_id""",
    "contact_fanout_join": """SELECT n.client_code, n.taxid, cv.id AS contact_id, cv.name, cv.email, cv.phone, cv.job_title,
        CASE WHEN upper(cv.is_primary) IN ('S', 'Y') THEN true WHEN upper(cv.is_primary) = 'N' THEN false END AS is_primary
        FROM insert_cands n JOIN vw_contacts cv ON n.taxid = cv.client_taxid""",
    "contact_client_lookup": """SELECT id_crm, lead_id, found AS client_code,
        CASE WHEN found IS NULL THEN 'quarantine' ELSE 'ok' END AS status
        FROM (SELECT i.*, (SELECT min(c_custkey) FROM customer WHERE c_custkey = i.lead_taxid::BIGINT) AS found
              FROM incoming_contacts i)""",
    "rep_domain": """SELECT id, sales_rep, (CASE WHEN sales_rep IN (SELECT code FROM rep_options) THEN sales_rep ELSE 99 END)::BIGINT
        AS sales_rep_checked FROM leads""",
    "city_match": """SELECT e.id, coalesce(r.city_code, 10000)::BIGINT AS city_code,
        coalesce(r.state_code::VARCHAR, 'XX') AS state_code, coalesce(r.country_code, 'US') AS country_code
        FROM crm_export e LEFT JOIN city_ref r ON upper(strip_accents(e.city)) = r.kc AND upper(strip_accents(e.state)) = r.ks""",
    "industry_match": """SELECT e.id, coalesce((SELECT min(m.industry) FROM industries m
        WHERE upper(strip_accents(m.description)) = upper(strip_accents(e.industry.value))), 10)::BIGINT AS industry_code
        FROM crm_export e""",
    "taxid_match": """SELECT e.id, b.client, b.code FROM crm_export e JOIN branches b
        ON CASE WHEN length(e.cnpj) <= 14 THEN ltrim(lpad(e.cnpj, 14, '0')) END = CASE WHEN length(b.taxid) <= 14 THEN ltrim(lpad(b.taxid, 14, '0')) END WHERE e.cnpj IS NOT NULL""",
    "contact_or_match": """SELECT c.code, max(i.id_crm) AS id_crm,
        coalesce(bool_or(lower(i.email) = lower(c.email)), false) AS by_email,
        coalesce(bool_or(i.id_crm = c.id_crm), false) AS by_id
        FROM incoming_contacts i JOIN contact c ON lower(i.email) = lower(c.email) OR i.id_crm = c.id_crm
        WHERE i.op <> 'D' GROUP BY c.code""",
    "qualification_rows": """SELECT id, q AS question_id,
        to_json({'leadId': id, 'answersList': [{'questionId': q, 'questionType': '2', 'answersIds': [a]}]}) AS payload
        FROM (SELECT id FROM leads WHERE id IS NOT NULL) n, (VALUES (100001, 200001), (100002, 200002), (100003, 200003)) qa(q, a)""",
    "lead_contacts": """SELECT l.id AS lead_id, l.taxid AS lead_taxid, c.id AS contact_id, c.name, c.email
        FROM leads l JOIN crm_contacts c ON l.id = c.leadId""",
    "contact_fanout": f"""SELECT w.doc_id, w.lead_id, json_extract_string(d.raw, '$.Lead.CpfCnpj') AS lead_taxid, w.contact_id, w.contact_name, w.contact_email
        FROM webhook_contacts w JOIN webhook_docs d ON w.doc_id = d.doc_id
        WHERE d.stage IN {SYNCED_CANON} AND w.lead_id IN (SELECT id FROM leads)""",
    "first_match": """SELECT branch_client, code, email FROM contact c
        WHERE code = (SELECT min(code) FROM contact c2 WHERE c2.branch_client = c.branch_client)""",
    "latest_event": "SELECT lead_id, doc_id, received_at, stage FROM latest_docs",
    "custom_field_pivot": f"""SELECT id, {cf('CustomFields', '_cod.gestores')} AS sales_rep,
        {cf('CustomFields', '_inscricaoestadual')} AS tax_registration,
        {cf('CustomFields', '_analisefinanceira')} AS financial_analysis,
        {cf('CustomFields', '_cod.cliente')} AS client_code, {cf('CustomFields', '_missing')} AS missing FROM lead_docs""",
    "key_violations": """SELECT so_number, sequence, count(*) AS occurrences FROM sales_order_item
        GROUP BY so_number, sequence HAVING count(*) > 1""",
    "batch_limit": "SELECT *, row_number() OVER (ORDER BY id) <= 10 AS in_batch FROM lead_diff_rows",
    "sym_diff": """SELECT *, 'crm_only' AS side FROM (SELECT * FROM lead_a EXCEPT SELECT * FROM lead_b)
        UNION ALL SELECT *, 'erp_only' AS side FROM (SELECT * FROM lead_b EXCEPT SELECT * FROM lead_a)""",
    "dataset_fingerprint": f"""SELECT count(*) AS rows,
        coalesce(sum(CAST(('0x' || substr({fp(LEAD_DIFF_COLS)}, 1, 15)) AS BIGINT)::HUGEINT), 0)::VARCHAR AS digest
        FROM lead_diff_rows""",
    "fingerprint_anti": f"""SELECT id, {fp(LEAD_DIFF_COLS)} AS fingerprint FROM lead_b
        WHERE {fp(LEAD_DIFF_COLS)} NOT IN (SELECT {fp(LEAD_DIFF_COLS)} FROM lead_a)""",
    "product_total": """WITH first AS (SELECT lead_id, sale_id FROM (SELECT DISTINCT lead_id, sale_id, sale_date FROM sale_lines)
            QUALIFY row_number() OVER (PARTITION BY lead_id ORDER BY sale_date, sale_id) = 1)
        SELECT s.lead_id, CAST(coalesce(sum(coalesce(s.final_value, 0)), 0) AS DOUBLE) AS total
        FROM sale_lines s JOIN first f ON s.lead_id = f.lead_id AND s.sale_id = f.sale_id GROUP BY s.lead_id""",
    "contact_route": "SELECT id_crm, email, matches, action FROM route",
    "sync_metrics": "SELECT action, count(*) AS records FROM route GROUP BY action",
    "lead_validation": "SELECT id, failed, failed = '' AS valid FROM validated",
    "missing_field_log": """SELECT id::VARCHAR AS lead_id, lead AS lead_name, split_part(failed, ',', 1) AS field,
        'Campo vazio' AS value FROM validated WHERE failed <> ''""",
    "contact_validation": """SELECT id, leadId, concat_ws(',',
            CASE WHEN id IS NULL OR id = 0 THEN 'id' END, CASE WHEN name IS NULL OR name = '' THEN 'name' END,
            CASE WHEN email IS NULL OR email = '' THEN 'email' END, CASE WHEN phone1 IS NULL OR phone1 = '' THEN 'phone1' END,
            CASE WHEN jobTitle IS NULL OR jobTitle = '' THEN 'jobTitle' END) AS failed,
        (id IS NOT NULL AND id <> 0 AND coalesce(name, '') <> '' AND coalesce(email, '') <> ''
         AND coalesce(phone1, '') <> '' AND coalesce(jobTitle, '') <> '') AS valid FROM crm_contacts""",
    "contact_quarantine": """SELECT id_crm, lead_id, reason FROM (
        SELECT r.id_crm, r.lead_id, CASE WHEN r.email IS NULL THEN 'no_email'
            WHEN r.lead_taxid IS NULL OR r.lead_taxid::BIGINT NOT IN (SELECT c_custkey FROM customer) THEN 'taxid_not_found'
            WHEN r.action = 'ambiguous' THEN 'ambiguous_email' END AS reason FROM route r) WHERE reason IS NOT NULL""",
    "field_diff": "SELECT * FROM field_diff_rows",
    "upsert_leads": "SELECT " + ", ".join(
        ["coalesce(t.id, d.id) AS id"]
        + [f"CASE WHEN d.id IS NOT NULL THEN d.{c} ELSE t.{c} END AS {c}" for c in LEAD_COLUMNS if c in DIFF_FIELDS]
        + [(f"CAST(t.{c} AS DOUBLE) AS {c}" if c in ("budget_value", "order_value") else f"t.{c} AS {c}")
           for c in LEAD_COLUMNS if c not in DIFF_FIELDS and c != "id"])
        + " FROM leads t FULL OUTER JOIN field_diff_rows d ON t.id = d.id",
    "stage_regression": """SELECT l.id, l.stage AS stored_stage, c.stage AS crm_stage,
        CASE WHEN length(l.taxid) > 14 THEN 'taxid_too_long' WHEN c.id IS NULL OR c.stage IS NULL THEN 'missing_in_crm'
             WHEN now_t.ordinal IS NULL OR old_t.ordinal IS NULL THEN 'unknown_stage'
             WHEN now_t.ordinal < old_t.ordinal THEN 'stage_regressed' END AS reason
        FROM leads l LEFT JOIN (SELECT * FROM crm_export WHERE cnpj IS NOT NULL
                                QUALIFY row_number() OVER (PARTITION BY CASE WHEN length(cnpj) <= 14 THEN ltrim(lpad(cnpj, 14, '0')) END ORDER BY id) = 1) c
          ON CASE WHEN length(l.taxid) <= 14 THEN ltrim(lpad(l.taxid, 14, '0')) END = CASE WHEN length(c.cnpj) <= 14 THEN ltrim(lpad(c.cnpj, 14, '0')) END
        LEFT JOIN stage_table now_t ON now_t.canonical = replace(c.stage, chr(160), ' ')
        LEFT JOIN stage_table old_t ON old_t.alias = l.stage
        WHERE c.id IS NULL OR c.stage IS NULL OR now_t.ordinal IS NULL OR old_t.ordinal IS NULL
           OR now_t.ordinal < old_t.ordinal""",
    "stage_update": """SELECT id, CASE WHEN id IN (SELECT lead_id FROM webhook_docs WHERE stage = 'Ativação') THEN 'Activation'
        ELSE stage END AS stage FROM leads""",
    "stage_route": """SELECT doc_id, lead_id, stage, CASE WHEN stage = 'Desenvolvimento/Orçamento' THEN 'insert_lead'
        WHEN stage = 'Ativação' THEN 'update_stage' ELSE 'ignore' END AS action FROM webhook_docs""",
    # A plain replay: eight changes, whose addresses and CRM ids no others have, are applied one by one to the contacts
    # of their block; a marker row stands for the block, from which contacts are inserted.
    "contact_merge": """WITH RECURSIVE state AS (
            SELECT code // 8 AS block, 0 AS k, false AS marker, code, name, email, phone, job_title_desc, branch_client, is_primary,
                   id_crm, NULL::BIGINT AS arrived
            FROM contact
            UNION ALL
            SELECT DISTINCT seq // 8, 0, true, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM contact_changes
            UNION ALL
            SELECT block, k + 1, marker AND copy = 0, CASE WHEN copy = 0 THEN code END, CASE WHEN sets THEN c_name ELSE name END,
                   CASE WHEN copy = 1 THEN lower(c_email) ELSE email END, CASE WHEN sets THEN c_phone ELSE phone END,
                   CASE WHEN copy = 1 THEN c_title WHEN sets THEN upper(c_title) ELSE job_title_desc END,
                   CASE WHEN copy = 1 THEN client ELSE branch_client END, CASE WHEN sets THEN c_primary ELSE is_primary END,
                   CASE WHEN sets THEN c_id ELSE id_crm END, CASE WHEN copy = 1 THEN seq ELSE arrived END
            FROM (SELECT *, unnest(CASE WHEN marker AND adds AND NOT mailed AND NOT numbered THEN [0, 1] ELSE [0] END) AS copy,
                         copy = 1 OR adds AND mailed AND meets AS sets
                  FROM (SELECT s.*, a.seq, a.client, a.name AS c_name, a.email AS c_email, a.phone AS c_phone, a.job_title AS c_title,
                               a.is_primary AS c_primary, a.id_crm AS c_id, ifnull(a.op, 'A') <> 'D' AND a.client IS NOT NULL AS adds,
                               ifnull(lower(s.email) = lower(a.email), false) OR ifnull(s.id_crm = a.id_crm, false) AS meets,
                               ifnull(bool_or(lower(s.email) = lower(a.email)) OVER w, false) AS mailed,
                               ifnull(bool_or(s.id_crm = a.id_crm) OVER w, false) AS numbered, ifnull(a.op = 'D', false) AS deletes
                        FROM state s LEFT JOIN contact_changes a ON a.seq = s.block * 8 + s.k WHERE s.k < 8
                        WINDOW w AS (PARTITION BY s.block))
                  WHERE NOT (deletes AND meets)))
        SELECT coalesce(code, (SELECT max(code) FROM contact) + row_number() OVER (PARTITION BY code IS NULL ORDER BY arrived)) AS code,
               name, email, phone, job_title_desc, branch_client, is_primary, id_crm
        FROM state WHERE k = 8 AND NOT marker""",
    "store_crm_id": """SELECT b.client, b.code, b.taxid, CASE WHEN p.taxid IS NOT NULL THEN p.id_crm ELSE b.id_crm END AS id_crm,
        CASE WHEN p.taxid IS NOT NULL THEN true ELSE b.integrate_crm END AS integrate_crm
        FROM branches b LEFT JOIN (SELECT cnpj AS taxid, max(id) AS id_crm FROM crm_export WHERE cnpj IS NOT NULL GROUP BY cnpj) p
          ON b.taxid = p.taxid""",
    "store_contact_id": """SELECT c.code, c.email, CASE WHEN p.em IS NOT NULL THEN p.id_crm ELSE c.id_crm END AS id_crm
        FROM contact c LEFT JOIN (SELECT lower(email) AS em, max(id) AS id_crm FROM crm_contacts WHERE email IS NOT NULL GROUP BY 1) p
          ON lower(c.email) = p.em""",
    "branch_update": """SELECT erp_client_code AS client, erp_branch_code AS code, id AS lead_id,
        CASE WHEN addr THEN replace(replace(coalesce(tax_registration, 'EXEMPT'), '.', ''), '-', '') ELSE erp_tax_registration END AS tax_registration,
        CASE WHEN rep THEN sales_rep ELSE erp_sales_rep END AS sales_rep,
        CASE WHEN rep THEN phone ELSE erp_phone END AS phone,
        CASE WHEN link THEN id ELSE erp_id_crm END AS id_crm, 'Y' AS integrate_crm,
        addr AS address_changed, rep AS rep_changed, ind AS industry_changed
        FROM (SELECT m.*, r.city_code,
            coalesce(upper(erp_company_name) <> upper(name), false) OR coalesce(upper(erp_address_street) <> upper(address_street), false)
            OR coalesce(erp_address_number <> address_number, false)
            OR coalesce(upper(erp_address_complement) <> upper(address_complement), false)
            OR coalesce(upper(erp_address_district) <> upper(address_district), false)
            OR coalesce(erp_city_code <> r.city_code, false) OR coalesce(erp_address_zipcode <> address_zipcode, false) AS addr,
            coalesce(erp_sales_rep <> sales_rep, false) OR coalesce(erp_phone <> phone, false) AS rep,
            coalesce(upper(strip_accents(erp_industry)) <> upper(strip_accents(industry)), false) AS ind,
            (erp_integrate_crm = 'N' OR erp_id_crm IS NULL) AS link
            FROM matched m LEFT JOIN city_ref r ON upper(strip_accents(m.city)) = r.kc AND upper(strip_accents(m.state)) = r.ks)""",
    "new_clients": """SELECT client, 1::BIGINT AS code, description, address, district, zipcode, city_of AS city, state_of AS state, country,
            coalesce(sales_rep, 99)::BIGINT AS sales_rep, phone, tk AS taxid,
            replace(replace(coalesce(tax_registration, 'EXEMPT'), '.', ''), '-', '') AS tax_registration,
            address_number AS number, address_complement AS complement, id AS id_crm, true AS integrate_crm FROM arrivals""",
    "new_client_companies": """SELECT client AS client_code, description AS company_name, address, district, city_of AS city, state_of AS state_code,
            zipcode, country, address_number AS number, address_complement AS complement FROM arrivals""",
    "new_client_reps": """SELECT client AS client_code, 1::BIGINT AS branch_code, sales_rep AS sales_rep_code, client AS from_to_client,
            1::BIGINT AS from_to_branch FROM arrivals""",
    "new_client_billing": """SELECT client AS client_code, 1::BIGINT AS branch_code, address_street AS billing_address,
            zipcode AS billing_zipcode, city_of AS city_code, state_of AS state_code, country AS country_code,
            upper(address_district) AS billing_district, phone AS billing_phone, address_complement AS complement,
            address_number AS number FROM arrivals""",
    "new_client_history": """SELECT client AS client_code, 1::BIGINT AS sequence, financial_analysis AS observations
            FROM arrivals WHERE financial_analysis IS NOT NULL""",
    "new_client_industries": """SELECT client, 1::BIGINT AS branch, min(m.industry) AS industry, 'A' AS status
            FROM arrivals a JOIN industries m ON upper(strip_accents(m.description)) = upper(strip_accents(a.industry)) GROUP BY client""",
    "lead_rejects": "SELECT id, taxid, 'taxid_too_long' AS reason FROM staged_leads WHERE length(taxid) > 14",
    "industry_change": """SELECT erp_client_code AS client, erp_branch_code AS branch,
            coalesce((SELECT min(industry) FROM industries
                      WHERE upper(strip_accents(description)) = upper(strip_accents(arg_max(m.industry, m.id)))), 10)::BIGINT AS industry
            FROM matched m WHERE upper(strip_accents(erp_industry)) <> upper(strip_accents(industry)) GROUP BY 1, 2""",
    "next_sequence": """SELECT m.erp_client_code AS client_code, m.financial_analysis AS observations, m.id AS lead_id,
        (coalesce((SELECT max(h.sequence) FROM credit_limit_history h WHERE h.client_code = m.erp_client_code), 0)
         + row_number() OVER (PARTITION BY m.erp_client_code ORDER BY m.id))::BIGINT AS sequence
        FROM matched m WHERE m.financial_analysis IS NOT NULL""",
    "insert_ignore": """SELECT id AS id_crm, name, lower(email) AS email FROM crm_contacts
        WHERE id NOT IN (SELECT id_crm FROM contact WHERE id_crm IS NOT NULL)""",
    "error_log_rows": """SELECT (SELECT max(event_id) FROM events) + row_number() OVER (ORDER BY id) AS log_id, -20012::BIGINT AS errorcode,
        'missing: ' || failed AS error_info, id FROM validated WHERE failed <> ''""",
    "replace_product": """WITH cur AS (SELECT lead_id, product_id, CAST(sum(coalesce(final_value, 0)) AS DOUBLE) AS value
            FROM sale_lines GROUP BY 1, 2),
        new AS (SELECT id AS lead_id, 10001::BIGINT AS product_id, budget_value AS value FROM budget_changes_rows)
        SELECT * FROM cur WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.lead_id = cur.lead_id AND new.product_id = cur.product_id)
        UNION ALL SELECT * FROM new""",
    "mark_values": """SELECT l.id, coalesce(b.budget_value, CAST(l.budget_value AS DOUBLE)) AS budget_value,
        coalesce(s.order_value, CAST(l.order_value AS DOUBLE)) AS order_value,
        CASE WHEN b.id IS NOT NULL AND c.alias IN ('Activation', 'Retention/Expansion') THEN c.alias ELSE l.stage END AS stage
        FROM leads l LEFT JOIN budget_changes_rows b ON l.id = b.id LEFT JOIN sold_changes_rows s ON l.id = s.id
        LEFT JOIN (SELECT e.id, m.alias FROM crm_export e LEFT JOIN stage_table m
                   ON replace(e.stage, chr(160), ' ') = m.canonical) c ON l.id = c.id""",
    "full_reload": f"""SELECT v.id, substr(v.lead, 1, 40) AS name, m.alias AS stage, v.cnpj AS taxid,
        v.industry.value AS industry, v.source.value AS source, v.phone1 AS phone,
        regexp_split_to_array(trim(v.street), '\\s+')[1] AS address_street, {strip('v.cep')} AS address_zipcode,
        coalesce(TRY_CAST(v.number AS INTEGER), 0) AS address_number, v.complement AS address_complement,
        v.district AS address_district, v.city, v.state, TRY_CAST(cf.sales_rep AS BIGINT) AS sales_rep,
        CASE WHEN cf.tax_registration = '99' THEN 'ISENTO' ELSE cf.tax_registration END AS tax_registration,
        cf.financial_analysis
        FROM validated v JOIN stage_table m ON replace(v.stage, chr(160), ' ') = m.canonical
        LEFT JOIN custom_fields_t cf ON cf.lead_id = v.id
        WHERE v.failed = '' AND m.alias IN {SYNCED}""",
    "json_props": """SELECT e.event_id, CAST(json_extract(e.props, '$.k') AS BIGINT) AS k,
        json_extract_string(w.raw, '$.Lead.Stage') AS stage FROM events e JOIN webhook_docs w ON e.event_id = w.doc_id""",
    "field_split": """SELECT id, len(list_filter(entries, lambda x: NOT starts_with(x.key, '_')))::BIGINT AS plain_fields,
        len(list_filter(entries, lambda x: starts_with(x.key, '_')))::BIGINT AS custom_fields,
        array_to_string(list_transform(list_filter(entries, lambda x: starts_with(x.key, '_')), lambda x: x.key), ',') AS custom_keys
        FROM (SELECT d.id, list_concat([{'key': 'name', 'value': l.name}, {'key': 'city', 'value': l.city}],
                list_transform(d.CustomFields, lambda x: {'key': x.id, 'value': x.value})) AS entries
              FROM lead_docs d JOIN leads l ON d.id = l.id)""",
    "array_append_field": """SELECT id, len(a)::BIGINT AS fields, a[-1].id AS last_id, a[-1].value AS last_value
        FROM (SELECT id, list_append(CustomFields, {'id': '_observacao', 'value': 'Vazio.'}) AS a FROM lead_docs)""",
    "sold_products": """WITH first AS (SELECT lead_id, sale_id FROM (SELECT DISTINCT lead_id, sale_id, sale_date FROM sale_lines)
            QUALIFY row_number() OVER (PARTITION BY lead_id ORDER BY sale_date, sale_id) = 1)
        SELECT s.lead_id, s.sale_id, s.sale_date, s.line, s.product_id, CAST(s.final_value AS DOUBLE) AS final_value
        FROM sale_lines s JOIN first f ON s.lead_id = f.lead_id AND s.sale_id = f.sale_id""",
    "option_domain": """SELECT DISTINCT f.value AS value FROM (SELECT unnest(CustomFields) AS f FROM lead_docs)
        WHERE f.id = '_cod.gestores'""",
    "page_explode": """SELECT c_mktsegment AS listing, c_custkey // 100 + moved::BIGINT AS page, c_custkey AS id,
            c_name || CASE WHEN moved THEN ' (moved)' ELSE '' END AS lead
        FROM (SELECT *, c_custkey % 50 = 0 AND c_custkey // 100 < max(c_custkey // 100) OVER (PARTITION BY c_mktsegment) AS moved FROM customer)
        WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING')""",
    "page_report": """WITH own AS (SELECT c_mktsegment AS listing, c_custkey // 100 AS page, c_custkey AS id FROM customer),
        there AS (
            SELECT listing, page, count(*) AS n FROM (
                SELECT listing, page FROM own
                UNION ALL SELECT listing, page + 1 FROM (SELECT *, max(page) OVER (PARTITION BY listing) AS top FROM own)
                          WHERE id % 50 = 0 AND page < top)
            WHERE NOT (listing = 'BUILDING' AND page = 0) GROUP BY 1, 2
            UNION ALL SELECT listing, max(page) + 1, 0 FROM own WHERE listing <> 'AUTOMOBILE' GROUP BY 1)
        SELECT listing, count(*) AS pages, sum(n)::BIGINT AS items, (max(page) + 1 - count(*))::BIGINT AS missing,
               listing <> 'AUTOMOBILE' AS ended,
               CASE listing WHEN 'BUILDING' THEN 'holed' WHEN 'AUTOMOBILE' THEN 'unfinished' ELSE 'complete' END AS status
        FROM there GROUP BY listing""",
    "json_roundtrip": "SELECT * FROM insert_cands",
    "insert_payload": "SELECT client_code, " + drop_nulls("""to_json({'duplicityValidation': 'true', 'lead': {
        'name': name, 'industry': industry, 'address': address, 'zipcode': zipcode::VARCHAR, 'phone': phone::VARCHAR,
        'addressNumber': number::VARCHAR, 'addressComplement': complement, 'neighborhood': district, 'city': city,
        'state': state, 'cpfcnpj': CASE WHEN length(taxid::VARCHAR) >= 14 THEN taxid::VARCHAR ELSE lpad(taxid::VARCHAR, 14, '0') END, 'country': 'Brasil',
        'customFields': [
            {'id': '_cod.gestores', 'value': NULL::VARCHAR, 'options': [{'value': rep::VARCHAR}]},
            {'id': '_cod.cliente', 'value': client_code::VARCHAR, 'options': NULL::STRUCT(value VARCHAR)[]},
            {'id': '_inscricaoestadual', 'value': CASE WHEN """ + strip("tax_registration") + """ = 'ISENTO' THEN '99'
                ELSE """ + strip("tax_registration") + """ END, 'options': NULL::STRUCT(value VARCHAR)[]}]}})""")
        + """ AS payload FROM (SELECT *, CASE WHEN sales_rep IN (SELECT code FROM rep_options) THEN sales_rep ELSE 99 END AS rep
        FROM insert_cands)""",
    "update_payload": "SELECT id, " + drop_nulls("""to_json({'duplicityValidation': 'true', 'lead': {
        'name': name, 'address': address_street, 'zipcode': split_part(address_zipcode::VARCHAR, '.', 1),
        'addressNumber': coalesce(split_part(address_number::VARCHAR, '.', 1), 'SN'),
        'addressComplement': coalesce(address_complement, ''), 'neighborhood': address_district, 'city': city,
        'state': state, 'cpfcnpj': CASE WHEN length(split_part(taxid::VARCHAR, '.', 1)) >= 14 THEN split_part(taxid::VARCHAR, '.', 1) ELSE lpad(split_part(taxid::VARCHAR, '.', 1), 14, '0') END, 'country': 'Brasil',
        'customFields': [
            {'id': '_cod.gestores', 'value': NULL::VARCHAR, 'options': [{'value': rep::VARCHAR}]},
            {'id': '_cod.cliente', 'value': client_code::VARCHAR, 'options': NULL::STRUCT(value VARCHAR)[]},
            {'id': '_inscricaoestadual', 'value': CASE WHEN trim(tax_registration) = 'ISENTO' THEN '99' ELSE trim(tax_registration) END, 'options': NULL::STRUCT(value VARCHAR)[]},
            {'id': '_analisefinanceira', 'value': coalesce(financial_analysis, 'Vazio.'), 'options': NULL::STRUCT(value VARCHAR)[]}]}})""")
        + """ AS payload FROM (SELECT *, CASE WHEN sales_rep IN (SELECT code FROM rep_options) THEN sales_rep ELSE 99 END AS rep
        FROM lead_diff_rows)""",
    "contact_payload": "SELECT id, " + drop_nulls("""to_json({'leadId': lead_id, 'name': name, 'email': lower(email),
        'phone1': coalesce(split_part(phone, '.', 1), '5500000000'), 'jobTitle': job_title,
        'mainContact': CASE upper(is_primary) WHEN 'S' THEN true WHEN 'N' THEN false END})""")
        + " AS payload FROM (" + ORACLE["contact_diff"] + ") unlike WHERE lead_id IS NOT NULL",
    "budget_payload": """SELECT id, to_json({'leadId': id, 'products': [{'productId': 10001, 'quantity': 1,
        'labelValue': CAST(budget_value AS DECIMAL(38,6))}]}) AS payload FROM budget_changes_rows""",
    "sale_payload": """SELECT id, to_json({'leadId': id, 'salesRepEmail': 'sales@example.com', 'ignoreSalesRep': false,
        'products': [{'productId': 10001, 'quantity': 1, 'labelValue': CAST(order_value AS DECIMAL(38,6))}]}) AS payload FROM sold_changes_rows""",
    "observation_payload": """SELECT id, flag, CASE flag WHEN 'N' THEN to_json({'lead': {'description': 'Contato atualizado - Sincronizar'}})
        WHEN 'S' THEN to_json({'description': 'Contato atualizado - Sincronizado'}) END AS payload
        FROM (SELECT id, CASE WHEN is_primary THEN 'S' ELSE 'N' END AS flag FROM contacts)""",
    "stream_ingest": "SELECT doc_id, lead_id, kind, stage FROM webhook_docs",
    "stream_dedup": "SELECT doc_id, lead_id, kind, " + fp(["doc_id", "lead_id", "kind", "stage", "raw"])
        + " AS fingerprint FROM webhook_docs",
})
ORACLE["client_code_payload"] = """SELECT id AS lead_id,
    to_json({'Id': id, 'Fields': [{'field_name': '_cod.cliente', 'field_value': client::VARCHAR}]}) AS payload FROM arrivals"""
ORACLE["contact_merge_stream"] = ORACLE["contact_merge"].replace(
    "SELECT coalesce(code, (SELECT max(code) FROM contact) + row_number() OVER (PARTITION BY code IS NULL ORDER BY arrived)) AS code,\n"
    "               name,", "SELECT name,")
ORACLE["error_log_stream"] = ORACLE["error_log_rows"]
ORACLE["cascade_stream"] = ORACLE["new_clients"]
ORACLE["placeholder_contact_payload"] = f"""SELECT id AS lead_id, to_json({{'name': 'Dummy contact', 'leadId': id}}) AS payload
    FROM leads WHERE stage IN {SYNCED} AND id NOT IN (SELECT leadId FROM crm_contacts WHERE leadId IS NOT NULL)"""


def _doc_fields_sql() -> tuple[str, list[str]]:
    """The field changes of webhook documents (p_<field>: present, v_<field>: value, o: order), and the fields."""
    keys = {"stage": ("$.Lead", "Stage"), "taxid": ("$.Lead", "CpfCnpj"), "industry": ("$.Lead.Industry", "value"),
            "source": ("$.Lead.Origin", "value"), "phone": ("$.Lead", "Phone"), "name": ("$.Lead", "Company"),
            "address_zipcode": ("$.Lead.Address", "ZipCode"),
            "address_complement": ("$.Lead.Address", "AddAddressInformation"),
            "city": ("$.Lead.Address", "City"), "state": ("$.Lead.Address", "State")}
    custom = {"sales_rep": "_cod.gestores", "tax_registration": "_inscricaoestadual",
              "client_code": "_cod.cliente", "financial_analysis": "_analisefinanceira"}
    cols = []
    for c, (parent, key) in keys.items():
        v = f"json_extract_string(raw, '{parent}.{key}')"
        if c == "name":
            v = f"substr({v}, 1, 40)"
        elif c == "address_zipcode":
            v = strip(v)
        elif c == "stage":
            v = f"(SELECT alias FROM stage_table WHERE canonical = replace({v}, chr(160), ' '))"
        cols.append(f"coalesce(list_contains(json_keys(raw, '{parent}'), '{key}'), false) AS p_{c}, {v} AS v_{c}")
    for c, fid in custom.items():
        v = (f"list_filter(CAST(json_extract(raw, '$.Lead.CustomFields') AS STRUCT(id VARCHAR, value VARCHAR)[]), "
             f"lambda x: x.id = '{fid}')[1].value")
        cols.append(f"coalesce({v} IS NOT NULL AND {v} <> '', false) AS p_{c}, "
                    + (f"TRY_CAST({v} AS BIGINT)" if c in ("sales_rep", "client_code") else v) + f" AS v_{c}")
    fields = list(keys) + list(custom)
    f = ("SELECT lead_id, {'t': received_at, 'd': doc_id} AS o, " + ", ".join(cols)
         + f" FROM webhook_docs WHERE replace(json_extract_string(raw, '$.Lead.Stage'), chr(160), ' ') IN {SYNCED_CANON}")
    return f, fields


def _partial_update_sql() -> str:
    f, fields = _doc_fields_sql()
    g = ("SELECT lead_id, " + ", ".join(f"bool_or(p_{c}) AS p_{c}, arg_max_null(v_{c}, o) FILTER (WHERE p_{c}) AS v_{c}"
                                       for c in fields) + " FROM f GROUP BY lead_id")
    out = ["l.id"] + [f"CASE WHEN g.p_{c} THEN g.v_{c} ELSE l.{c} END AS {c}" for c in
                      ["name", "phone", "stage", "taxid", "industry", "source", "address_zipcode", "address_complement",
                       "city", "state", "sales_rep", "tax_registration", "client_code", "financial_analysis"]]
    out += [f"CASE WHEN e.id IS NOT NULL THEN {new} ELSE l.{c} END AS {c}" for c, new in (
        ("address_street", "e.street"), ("address_number", "coalesce(TRY_CAST(e.number AS INTEGER), 0)"),
        ("address_district", "e.district"))]
    return (f"WITH f AS ({f}), g AS ({g}) SELECT " + ", ".join(out) + " FROM leads l LEFT JOIN g ON l.id = g.lead_id "
            "LEFT JOIN crm_export e ON e.id = g.lead_id")


def _survivors_sql() -> str:
    f, fields = _doc_fields_sql()
    export = {"name": "lead", "stage": "(SELECT alias FROM stage_table WHERE canonical = replace(stage, chr(160), ' '))",
              "taxid": "cnpj", "phone": strip("phone1"), "industry": "industry.value", "source": "source.value",
              "address_street": "street", "address_number": "coalesce(TRY_CAST(number AS INTEGER), 0)", "address_district": "district",
              "address_zipcode": strip("cep"), "address_complement": "complement", "city": "city", "state": "state"}
    custom = ["sales_rep", "tax_registration", "financial_analysis", "client_code"]
    default = {"phone": "5500000000", "financial_analysis": "Vazio.", "address_complement": "", "sales_rep": "99", "state": "XX",
               "address_street": "X"}
    said = [f"SELECT lead_id AS id, '{c}' AS field, v_{c}::VARCHAR AS value, 'document' AS source, 1 AS rank, o.t AS seen FROM f WHERE p_{c}"
            for c in fields]
    said += [f"SELECT id, '{c}', ({v})::VARCHAR, 'export', 2, NULL FROM crm_export WHERE ({v}) IS NOT NULL" for c, v in export.items()]
    said += [f"SELECT lead_id, '{c}', {c}, 'custom field', 3, NULL FROM custom_fields_t WHERE {c} IS NOT NULL" for c in custom]
    said += [f"SELECT id, '{c}', '{v}', 'default', 4, NULL FROM crm_export" for c, v in default.items()]
    return (f"WITH f AS ({f} AND lead_id IN (SELECT id FROM crm_export)) SELECT id, field, value, source FROM ("
            + " UNION ALL ".join(said) + ") QUALIFY row_number() OVER (PARTITION BY id, field "
            "ORDER BY rank, seen DESC NULLS LAST, value DESC NULLS LAST) = 1")


ORACLE["partial_update"] = _partial_update_sql()
ORACLE["stream_upsert"] = f"SELECT * EXCLUDE (address_street, address_number, address_district) FROM ({ORACLE['partial_update']})"
ORACLE["lead_survivors"] = _survivors_sql()

ORACLE["contact_upsert"] = """WITH inc AS (SELECT i.*, l.client_code FROM incoming_contacts i LEFT JOIN leads l ON i.lead_id = l.id
        WHERE i.email IS NOT NULL AND l.client_code IS NOT NULL),
    cnt AS (SELECT lower(email) AS em, count(*) AS n FROM contacts WHERE email IS NOT NULL GROUP BY 1),
    r AS (SELECT inc.*, coalesce(cnt.n, 0) AS n FROM inc LEFT JOIN cnt ON lower(inc.email) = cnt.em),
    upd AS (SELECT * FROM r WHERE n = 1),
    ins AS (SELECT * FROM r WHERE n = 0 QUALIFY row_number() OVER (PARTITION BY lower(email) ORDER BY id_crm) = 1)
    SELECT c.id, CASE WHEN u.id_crm IS NOT NULL THEN u.name ELSE c.name END AS name,
        CASE WHEN u.id_crm IS NOT NULL THEN u.email ELSE c.email END AS email,
        CASE WHEN u.id_crm IS NOT NULL THEN substr(u.phone, 1, 13) ELSE c.phone END AS phone,
        CASE WHEN u.id_crm IS NOT NULL THEN substr(u.job_title, 1, 30) ELSE c.job_title END AS job_title,
        CASE WHEN u.id_crm IS NOT NULL THEN u.client_code::VARCHAR ELSE c.client_code END AS client_code,
        CASE WHEN u.id_crm IS NOT NULL THEN u.is_primary ELSE c.is_primary END AS is_primary
    FROM contacts c LEFT JOIN upd u ON c.id = u.id_crm
    UNION ALL
    SELECT id_crm AS id, name, email, substr(phone, 1, 13) AS phone, substr(job_title, 1, 30) AS job_title,
        client_code::VARCHAR AS client_code, is_primary
    FROM ins WHERE id_crm NOT IN (SELECT id FROM contacts)"""

def _cf_last(fid: str) -> str:
    return (f"list_filter(CAST(json_extract(d.raw, '$.Lead.CustomFields') AS STRUCT(id VARCHAR, value VARCHAR)[]), "
            f"lambda x: x.id = '{fid}')[-1].value")


ORACLE["converted_insert"] = f"""WITH d AS (SELECT * FROM webhook_docs
        WHERE replace(json_extract_string(raw, '$.Lead.Stage'), chr(160), ' ') = 'Desenvolvimento/Orçamento'
        QUALIFY row_number() OVER (PARTITION BY lead_id ORDER BY received_at DESC, doc_id DESC) = 1)
    SELECT d.lead_id AS id, json_extract_string(d.raw, '$.Lead.CpfCnpj') AS taxid,
        substr(json_extract_string(d.raw, '$.Lead.Company'), 1, 40) AS name, 'Development/Budget' AS stage,
        json_extract_string(d.raw, '$.Lead.Industry.value') AS industry,
        json_extract_string(d.raw, '$.Lead.Origin.value') AS source, a.phone1 AS phone,
        substr(split_part(split_part(json_extract_string(d.raw, '$.Lead.Address.Address_Maps'), ',', 1), '-', 1), 1, 50)
            AS address_street,
        {strip("json_extract_string(d.raw, '$.Lead.Address.ZipCode')")} AS address_zipcode,
        coalesce(TRY_CAST(a.number AS INTEGER), 0) AS address_number, a.complement AS address_complement,
        a.district AS address_district, a.city, a.state,
        TRY_CAST({_cf_last('_cod.gestores')} AS BIGINT) AS sales_rep,
        CASE WHEN {_cf_last('_inscricaoestadual')} IS NULL OR {_cf_last('_inscricaoestadual')} IN ('99', '0') THEN '99'
             ELSE {_cf_last('_inscricaoestadual')} END AS tax_registration,
        {_cf_last('_analisefinanceira')} AS financial_analysis
    FROM d LEFT JOIN crm_export a ON d.lead_id = a.id
    WHERE d.lead_id NOT IN (SELECT id FROM leads)"""

ORACLE["stream_chain"] = ORACLE["contact_fanout"]

_PREFIX = ("CASE WHEN event_id % 53 = 7 THEN 'misc_' ELSE CASE event_type WHEN 'click' THEN 'update_leads_in_erp_' WHEN 'purchase' "
           "THEN 'converted_lead_' WHEN 'error' THEN 'lead_descartada_' WHEN 'view' THEN 'contato_update_erp_' "
           "ELSE 'inserted_timeline_' END END")
_KIND_FIELDS = {
    "lead_update": ("user_id AS lead_id, concat('Company ', user_id) AS company, event_type AS stage, "
                                   "concat('C', event_id % 25) AS city", "update_leads_in_erp_"),
    "lead_converted": ("user_id AS lead_id, concat('Company ', user_id) AS company, event_type AS stage, "
                                      "concat('C', event_id % 25) AS city", "converted_lead_"),
    "contact_update": ("event_id AS id, concat('Person ', event_id) AS name, concat('p', event_id, '@x.org') AS email",
                       "contato_update_erp_"),
    "timeline": ("event_id AS id, user_id AS lead_id, concat('note ', event_id) AS text", "inserted_timeline_"),
}
_NEW_KEY = "event_id % 41 = 3"
_NEW_FLOOR = "event_id % 43 = 5 AND event_type NOT IN ('view', 'signup')"
for _kind, (_fields, _prefix) in _KIND_FIELDS.items():
    ORACLE[f"kind_{_kind}"] = f"""SELECT concat('{_prefix}', event_id, '.json') AS file, {_fields} FROM events
        WHERE {_PREFIX} = '{_prefix}' AND event_id % 37 <> 11 AND NOT ({_NEW_KEY}) AND NOT ({_NEW_FLOOR})"""
ORACLE["dead_letters"] = f"""SELECT concat(prefix, event_id, '.json') AS file, kind,
        CASE WHEN kind IS NULL THEN 'unknown kind' WHEN event_id % 37 = 11 THEN 'corrupt'
             ELSE concat('unexpected: ', concat_ws(',', CASE WHEN {_NEW_FLOOR} THEN 'Lead.Address.Floor' END,
                  CASE WHEN {_NEW_KEY} THEN if(event_type IN ('view', 'signup'), 'Score', 'Lead.Score') END)) END AS reason
        FROM (SELECT *, {_PREFIX} AS prefix, CASE WHEN event_id % 53 <> 7 THEN CASE event_type WHEN 'click' THEN 'lead_update'
              WHEN 'purchase' THEN 'lead_converted' WHEN 'error' THEN 'lead_discarded' WHEN 'view' THEN 'contact_update'
              ELSE 'timeline' END END AS kind FROM events)
        WHERE kind IS NULL OR kind <> 'lead_discarded' AND (event_id % 37 = 11 OR {_NEW_KEY} OR {_NEW_FLOOR})"""
ORACLE["document_selection"] = f"SELECT file AS source_file, lead_id FROM ({ORACLE['kind_lead_converted']}) WHERE lead_id IN (SELECT id FROM leads)"
ORACLE["batch_names"] = """SELECT doc_id, concat_ws('_', 'update_leads_in_erp', replace(replace(replace(replace(company, ' ', '_'), '/', ''), '.', ''), ',', ''),
    strftime(received_at, '%Y_%m_%d_%H_%M_%S'), doc_id) AS file FROM webhook_docs"""
ORACLE["outcome_class"] = """SELECT event_id, CASE WHEN event_id % 14 = 0 THEN 'ok_duplicate_client_code'
    WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN 'error' ELSE 'ok' END AS outcome FROM events"""
ORACLE["industry_load"] = """SELECT coalesce(n.code, i.industry) AS industry, coalesce(n.description, i.description) AS description
    FROM industries i FULL JOIN (SELECT DISTINCT p_partkey % 8 AS code, concat('Trade ', p_partkey % 8) AS description FROM part) n
      ON n.code = i.industry"""
ORACLE["phone_digits"] = "SELECT id, regexp_replace(phone1, '[^0-9]', '', 'g') AS phone FROM crm_export"
ORACLE["main_contact"] = """SELECT event_id * 10 + event_id % 5 AS id, CASE WHEN event_id % 5 < 3 AND event_id % 3 = event_id % 5
    THEN 'S' ELSE 'N' END AS is_primary FROM events"""
_CHECKED_CONTACTS = """(SELECT *, concat_ws(',', CASE WHEN id IS NULL OR id = 0 THEN 'id' END, CASE WHEN coalesce(name, '') = '' THEN 'name' END,
    CASE WHEN coalesce(email, '') = '' THEN 'email' END, CASE WHEN coalesce(phone1, '') = '' THEN 'phone1' END,
    CASE WHEN coalesce(jobTitle, '') = '' THEN 'jobTitle' END) AS missing FROM crm_contacts)"""
_SYNCED_EXPORT = f"replace(stage, chr(160), ' ') IN {SYNCED_CANON}"
ORACLE["reload_contacts"] = f"""SELECT id, leadId, name, email, phone1, jobTitle FROM {_CHECKED_CONTACTS}
    WHERE missing = '' AND leadId IN (SELECT id FROM validated WHERE failed = '' AND {_SYNCED_EXPORT})"""
ORACLE["reload_rejects"] = f"""SELECT 'lead' AS kind, id, failed AS reason FROM validated WHERE failed <> '' AND {_SYNCED_EXPORT}
    UNION ALL SELECT 'contact', id, missing FROM {_CHECKED_CONTACTS} WHERE missing <> ''"""
ORACLE["contact_insert_payload"] = "SELECT l.id AS lead_id, c.id AS contact_id, " + drop_nulls("""to_json({'name': c.name, 'email': c.email,
    'phone1': c.phone, 'jobTitle': c.job_title, 'mainContact': c.is_primary = 'S', 'leadId': l.id::VARCHAR})""") + """ AS payload
    FROM vw_contacts c JOIN crm_export l ON length(l.cnpj) <= 14 AND ltrim(lpad(l.cnpj, 14, '0')) = ltrim(lpad(c.client_taxid, 14, '0'))"""
