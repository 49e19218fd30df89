"""Oracle SQL (DuckDB dialect) for every registered query.

The stand-in rules of ``sources.standins`` are CTEs over the driver tables.  The
client and contact views and their measures are computed from the driver tables,
client by client, and the change sets by comparing (id, field, value) rows or
whole sets, so they share no plan with the Spark side.  Other bodies read the
stand-ins.  The driver tables are pre-registered views with the same names.
"""

from __future__ import annotations

from ..schemas import LEAD_DIFF_COLS, STAGES_ALIAS, STAGES_CANONICAL

_STAGE_LIST = "[" + ", ".join("'" + s.replace("'", "''") + "'" for s in STAGES_ALIAS) + "]"
_STAGE_CANON = "[" + ", ".join("'" + s.replace("'", "''") + "'" for s in STAGES_CANONICAL) + "]"

BASE = "TIMESTAMP '1998-01-01 00:00:00'"

SEG_CODE = ("(CASE {c} WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3 "
            "WHEN 'HOUSEHOLD' THEN 4 WHEN 'MACHINERY' THEN 5 END)::BIGINT")
COUNTRY = "(CASE {r} WHEN 0 THEN 'AF' WHEN 1 THEN 'US' WHEN 2 THEN 'AS' WHEN 3 THEN 'EU' ELSE 'ME' END)"


def initcap2(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '([\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+)', 1), "
            f"lambda w: upper(w[1]) || lower(w[2:])), '')")


STANDINS = {
    "cities": f"""SELECT n_nationkey::BIGINT AS id, n_nationkey::BIGINT AS city_code, n_name AS city_name,
        n_regionkey::BIGINT AS state_code, {COUNTRY.format(r='n_regionkey')} AS country_code FROM nation""",
    "states": "SELECT r_regionkey::BIGINT AS code, r_name AS name FROM region",
    "countries": f"SELECT {COUNTRY.format(r='r_regionkey')} AS code, r_name AS name FROM region",
    "clients": "SELECT c_custkey AS client_code, c_name AS company_name FROM customer",
    "branches": """SELECT c_custkey AS client, 1::BIGINT AS code, c_name AS description,
        lpad(c_custkey::VARCHAR, 14, '0') AS taxid, (c_custkey % 10)::BIGINT AS sales_rep,
        c_nationkey::BIGINT AS city, lpad((c_custkey % 99991)::VARCHAR, 8, '0') AS zipcode,
        'Rua ' || c_mktsegment || ' ' || c_nationkey::VARCHAR AS address, (c_custkey % 997)::INTEGER AS number,
        c_mktsegment AS district,
        CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'Sala ' || (c_custkey % 50)::VARCHAR END AS complement,
        'client' || c_custkey::VARCHAR || '@example.com' AS email,
        CASE WHEN c_custkey % 3 = 0 THEN 'ISENTO' ELSE ((c_custkey * 7919) % 1000000)::VARCHAR END AS tax_registration,
        '55119' || lpad(c_custkey::VARCHAR, 8, '0') AS phone,
        CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey END AS id_crm,
        (c_custkey % 2 = 0) AS integrate_crm
        FROM customer""",
    "industries": f"SELECT DISTINCT {SEG_CODE.format(c='c_mktsegment')} AS industry, lower(c_mktsegment) AS description FROM customer",
    "client_industries": f"""SELECT c_custkey AS client, 1::BIGINT AS branch, {SEG_CODE.format(c='c_mktsegment')} AS industry, 'A' AS status FROM customer
        UNION ALL
        SELECT c_custkey, 1::BIGINT, ({SEG_CODE.format(c='c_mktsegment')} % 5 + 1)::BIGINT, 'A' FROM customer WHERE c_custkey % 3 = 0""",
    "credit_limit_history": """SELECT user_id AS client_code, event_id AS sequence, CAST(ts AS DATE) AS date,
        event_type AS observations, 'SYSTEM' AS "user" FROM events""",
    "sales_reps": "SELECT s_suppkey AS code, 'rep' || s_suppkey::VARCHAR || '@example.com' AS email FROM supplier",
    "person": "SELECT c_custkey AS code, c_custkey AS key1, 1::BIGINT AS key2 FROM customer",
    "sales_order": "SELECT 1::BIGINT AS company_code, o_orderkey AS number, o_custkey AS pers_code FROM orders",
    "sales_order_item": """SELECT 1::BIGINT AS so_company_code, l_orderkey AS so_number, l_linenumber AS sequence,
        l_quantity::DECIMAL(18,2) AS item_qty, l_shipdate AS item_date FROM lineitem""",
    "sales_order_item_delivery": """SELECT 1::BIGINT AS sod_company_code, l_orderkey AS sod_number, l_linenumber AS sequence,
        l_extendedprice::DECIMAL(18,2) AS unit_value, CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS billing_client
        FROM lineitem""",
    "budget": "SELECT o_orderkey AS number, o_custkey AS client_billing_code, 1::BIGINT AS branch_billing_code FROM orders",
    "order_items": """SELECT k.k, k.item, o.* FROM (SELECT DISTINCT l_orderkey AS k, l_returnflag AS item FROM lineitem) k
        JOIN orders o ON k.k = o.o_orderkey""",
    "budget_item": """SELECT k AS bdg_number, item, o_orderdate AS date,
        CASE WHEN o_orderstatus = 'F' THEN 'N' ELSE 'Y' END AS generated FROM order_items""",
    "budget_item_delivery": """SELECT k AS bit_bdg_number, item AS bit_item, o_custkey AS client_code, 1::BIGINT AS branch_code,
        CASE WHEN k % 7 = 0 THEN 'N' ELSE 'Y' END AS billing_client,
        CASE WHEN k % 11 = 0 THEN NULL ELSE o_orderdate END AS approval_date FROM order_items""",
    "budget_item_quantity": """SELECT DISTINCT l_orderkey AS bit_bdg_number, l_returnflag AS bit_item,
        l_quantity::DECIMAL(18,2) AS quantity FROM lineitem""",
    "budget_item_quant_delivery": """SELECT l_orderkey AS bid_bdg_number, l_returnflag AS bid_item,
        l_quantity::DECIMAL(18,2) AS bid_quantity, o_custkey AS client_code, 1::BIGINT AS branch_code,
        l_extendedprice::DECIMAL(18,2) AS price,
        CASE WHEN l_linenumber % 3 = 0 THEN 0::DECIMAL(18,2) WHEN l_linenumber % 3 = 1 THEN NULL
             ELSE (l_extendedprice::DECIMAL(18,2) - l_quantity::DECIMAL(18,2))::DECIMAL(18,2) END AS negotiated_price
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "service_order": """SELECT o_custkey AS client, 1::BIGINT AS branch, 1::BIGINT AS company_code, 1::BIGINT AS branch_code,
        1::BIGINT AS sales_rep_code, o_orderkey AS number FROM orders""",
    "service_order_item": """SELECT 1::BIGINT AS soi_company_code, 1::BIGINT AS soi_branch_code, 1::BIGINT AS soi_sales_rep_code,
        o_orderkey AS soi_number, o_orderdate AS create_date,
        CASE WHEN o_orderstatus = 'F' THEN 'C' ELSE o_orderstatus END AS status FROM orders""",
    "contact": """SELECT event_id AS code, 'Contact ' || event_id::VARCHAR AS name,
        'u' || (event_id - CASE WHEN event_id % 4 = 3 THEN 1 ELSE 0 END)::VARCHAR || '@x.org' AS email, '5521' || lpad(event_id::VARCHAR, 8, '0') AS phone,
        CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'Buyer' END AS job_title_desc,
        (event_id % 4)::BIGINT AS job_title_code, user_id AS branch_client, 1::BIGINT AS branch_code,
        CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id END AS id_crm,
        CASE WHEN event_id % 2 = 0 THEN 'S' ELSE 'N' END AS is_primary
        FROM events""",
    "contact_job_titles": """SELECT r_regionkey::BIGINT AS job_title_code, upper(r_name[1]) || lower(r_name[2:]) AS title
        FROM region WHERE r_regionkey < 3""",
    "contacts": """SELECT event_id AS id,
        CASE WHEN event_id % 7 = 0 THEN 'Contato ' || event_id::VARCHAR ELSE 'contact ' || event_id::VARCHAR END AS name,
        'u' || (event_id - CASE WHEN event_id % 4 = 3 THEN 1 ELSE 0 END)::VARCHAR || '@x.org' AS email, '5521' || lpad(event_id::VARCHAR, 8, '0') AS phone,
        CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'buyer' END AS job_title,
        user_id::VARCHAR AS client_code, (event_id % 2 = 0) AS is_primary
        FROM events WHERE event_id % 5 <> 0""",
    "incoming_contacts": """SELECT event_id AS id_crm, 'Contact ' || event_id::VARCHAR AS name,
        CASE WHEN event_id % 9 = 0 THEN NULL ELSE upper('u' || (event_id - event_id % 8 + event_id % 4)::VARCHAR || '@x.org') END AS email,
        '5521' || lpad(event_id::VARCHAR, 8, '0') AS phone, 'Buyer' AS job_title, user_id AS lead_id,
        (event_id % 2 = 0) AS is_primary, CASE WHEN event_id % 10 = 3 THEN 'D' ELSE 'A' END AS op,
        CASE WHEN event_id % 29 <> 0 THEN lpad(user_id::VARCHAR, 14, '0') END AS lead_taxid
        FROM events""",
    "contact_changes": """SELECT event_id AS seq, CASE WHEN event_id % 31 <> 0 THEN user_id END AS client,
        'Change ' || event_id::VARCHAR AS name,
        CASE WHEN event_id % 9 <> 0 THEN upper('u' || (event_id - event_id % 8 + event_id % 8 // 3)::VARCHAR || '@x.org') END AS email,
        '5521' || lpad(event_id::VARCHAR, 8, '0') AS phone, CASE WHEN event_id % 4 <> 0 THEN 'Buyer' END AS job_title,
        CASE WHEN event_id % 2 = 0 THEN 'S' ELSE 'N' END AS is_primary,
        CASE WHEN event_id % 11 <> 0 THEN event_id - event_id % 8 + event_id % 4 * 2 + 1 END AS id_crm,
        CASE WHEN event_id % 10 = 3 THEN 'D' WHEN event_id % 13 <> 0 THEN 'A' END AS op FROM events""",
    "leads": f"""SELECT c_custkey AS id,
        CASE WHEN c_custkey % 7 = 0 THEN c_name || ' LTDA' ELSE c_name END AS name,
        {_STAGE_LIST}[(c_custkey % 8 + 1)::INTEGER] AS stage,
        coalesce(CASE c_custkey % 41 WHEN 5 THEN '99' || lpad(c_custkey::VARCHAR, 14, '0') WHEN 6 THEN '9' || lpad(c_custkey::VARCHAR, 14, '0') END, c_custkey::VARCHAR) AS taxid, c_mktsegment AS industry,
        CASE WHEN c_custkey % 2 = 0 THEN 'ERP' ELSE 'Site' END AS source,
        '55119' || lpad(c_custkey::VARCHAR, 8, '0') AS phone,
        CASE WHEN c_custkey % 4 = 1 THEN lower('Rua ' || c_mktsegment || ' ' || c_nationkey::VARCHAR)
             ELSE 'Rua ' || c_mktsegment || ' ' || c_nationkey::VARCHAR END AS address_street,
        lpad((c_custkey % 99991)::VARCHAR, 8, '0') AS address_zipcode,
        (CASE WHEN c_custkey % 13 = 0 THEN (c_custkey % 997) + 1 ELSE c_custkey % 997 END)::INTEGER AS address_number,
        CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'Sala ' || (c_custkey % 50)::VARCHAR END AS address_complement,
        c_mktsegment AS address_district, n_name AS city,
        CASE WHEN n_regionkey = 1 THEN r_name END AS state,
        (CASE WHEN c_custkey % 17 = 0 THEN 99 ELSE c_custkey % 10 END)::BIGINT AS sales_rep,
        CASE WHEN c_custkey % 3 = 0 THEN 'ISENTO' ELSE ((c_custkey * 7919) % 1000000)::VARCHAR END AS tax_registration,
        c_custkey AS client_code,
        (CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_acctbal END)::DECIMAL(18,2) AS budget_value,
        (CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal * 2 END)::DECIMAL(18,2) AS order_value,
        CASE WHEN c_custkey % 2 = 0 THEN 'signup' END AS financial_analysis
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE c_custkey % 3 <> 0""",
    # ---- what a view must say of each client or contact, computed from the driver tables -----------------
    "vw_base": f"""SELECT c_custkey::VARCHAR || '-1' AS id, c_custkey AS client_code, 1::BIGINT AS branch_code,
        c_name AS company_name, lpad(c_custkey::VARCHAR, 14, '0') AS taxid, (c_custkey % 10)::BIGINT AS sales_rep,
        {initcap2('r_name')} AS country, CASE r_regionkey WHEN 1 THEN {initcap2('r_name')} END AS state,
        {initcap2('n_name')} AS city, n_nationkey::BIGINT AS city_code,
        lpad((c_custkey % 99991)::VARCHAR, 8, '0') AS address_zipcode,
        concat('Rua ', c_mktsegment, ' ', n_nationkey) AS address_street, (c_custkey % 997)::INTEGER AS address_number,
        c_mktsegment AS address_district,
        CASE WHEN c_custkey % 4 <> 0 THEN concat('Sala ', c_custkey % 50) END AS address_complement,
        concat('client', c_custkey, '@example.com') AS email,
        CASE WHEN c_custkey % 3 = 0 THEN 'ISENTO' ELSE ((c_custkey * 7919) % 1000000)::VARCHAR END AS tax_registration,
        '55119' || lpad(c_custkey::VARCHAR, 8, '0') AS phone, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey END AS id_crm,
        CASE WHEN c_custkey % 2 = 0 THEN 'Y' ELSE 'N' END AS integrate_crm
        FROM customer, nation, region WHERE n_nationkey = c_nationkey AND r_regionkey = n_regionkey""",
    "vw_industry": """SELECT c_custkey AS client_code, 1::BIGINT AS branch_code, list_min(CASE WHEN c_custkey % 3 = 0
            THEN [own, names[list_position(names, own) % 5 + 1]] ELSE [own] END) AS industry
        FROM (SELECT c_custkey, c_mktsegment[1] || lower(c_mktsegment[2:]) AS own,
                     ['Automobile', 'Building', 'Furniture', 'Household', 'Machinery'] AS names FROM customer) t""",
    "vw_fa": """SELECT user_id AS client_code, max({'day': CAST(ts AS DATE), 'seen': event_type}).seen AS financial_analysis
        FROM events GROUP BY user_id""",
    "vw_budget": f"""SELECT o_custkey AS client_code, 1::BIGINT AS branch_code,
        CAST(sum(qty * CASE WHEN l_linenumber % 3 = 2 AND price <> qty THEN price - qty ELSE price END) AS DOUBLE) / 1000.0
            AS budget_value
        FROM (SELECT l_orderkey, l_linenumber, l_quantity::DECIMAL(18,2) AS qty, l_extendedprice::DECIMAL(18,2) AS price,
                     l_quantity = min(l_quantity) OVER (PARTITION BY l_orderkey, l_returnflag) AS is_tier FROM lineitem) l
        SEMI JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0
                     AND date_diff('day', {BASE}, o_orderdate) BETWEEN 0 AND 365) ok ON ok.o_orderkey = l.l_orderkey
        JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE is_tier GROUP BY o_custkey""",
    "vw_order": f"""SELECT o_custkey AS client_code, 1::BIGINT AS branch_code, CAST(sum(qty * price) AS DOUBLE) AS order_value
        FROM (SELECT l_orderkey, l_linenumber,
                     CAST(sum(l_quantity::DECIMAL(18,2)) FILTER (date_diff('day', {BASE}, l_shipdate) BETWEEN 0 AND 365)
                          AS DECIMAL(18,2)) AS qty,
                     CAST(sum(l_extendedprice::DECIMAL(18,2)) FILTER (l_linestatus = 'O') AS DECIMAL(18,2)) AS price
              FROM lineitem GROUP BY ALL) per_line  -- a line's number may repeat: every item meets every delivery
        JOIN orders ON o_orderkey = l_orderkey WHERE qty IS NOT NULL AND price IS NOT NULL GROUP BY o_custkey""",
    "vw_has_order": f"""SELECT o_custkey AS client_code, 1::BIGINT AS branch_code, 'Y' AS has_order,
        ['N', 'Y'][bool_or(l_shipdate >= {BASE} + INTERVAL 30 DAY)::INTEGER + 1] AS has_retention
        FROM lineitem, orders WHERE o_orderkey = l_orderkey AND l_shipdate >= {BASE} GROUP BY o_custkey""",
    # One row per client and fact, then one row per client again.
    "client_facts": """SELECT client_code, 'industry' AS fact, industry AS word, NULL::DOUBLE AS amount FROM vw_industry
        UNION ALL SELECT client_code, 'seen', financial_analysis, NULL FROM vw_fa
        UNION ALL SELECT client_code, 'ordered', has_order, NULL FROM vw_has_order
        UNION ALL SELECT client_code, 'kept', has_retention, NULL FROM vw_has_order
        UNION ALL SELECT client_code, 'budget', NULL, budget_value FROM vw_budget WHERE client_code <> 1001
        UNION ALL SELECT client_code, 'budget', NULL, 10000.0 FROM vw_base WHERE client_code = 1001
        UNION ALL SELECT client_code, 'sold', NULL, order_value FROM vw_order WHERE client_code <> 1002
        UNION ALL SELECT client_code, 'sold', NULL, 10000.0 FROM vw_base WHERE client_code = 1002
        UNION ALL SELECT c_custkey, 'rep', concat('rep', s_suppkey, '@example.com'), NULL
            FROM customer JOIN supplier ON s_suppkey = c_custkey % 10""",
    "vw_crm_clients": """SELECT b.*, f.* EXCLUDE (code) FROM vw_base b LEFT JOIN (
            SELECT client_code AS code, any_value(word) FILTER (fact = 'industry') AS industry,
                   any_value(word) FILTER (fact = 'seen') AS financial_analysis,
                   any_value(amount) FILTER (fact = 'budget') AS budget_value,
                   ifnull(any_value(word) FILTER (fact = 'ordered'), 'N') AS has_order,
                   any_value(amount) FILTER (fact = 'sold') AS order_value,
                   ifnull(any_value(word) FILTER (fact = 'kept'), 'N') AS has_retention,
                   any_value(word) FILTER (fact = 'rep') AS sales_rep_email
            FROM client_facts GROUP BY client_code) f ON f.code = b.client_code""",
    "vw_contacts": """SELECT event_id AS id, concat('Contact ', event_id) AS name, concat('u', if(event_id % 4 = 3, event_id - 1, event_id), '@x.org') AS email,
        '5521' || lpad(event_id::VARCHAR, 8, '0') AS phone,
        CASE WHEN event_id % 3 <> 0 THEN 'Buyer' WHEN event_id % 4 < 3
             THEN (SELECT any_value(r_name[1] || lower(r_name[2:])) FROM region WHERE r_regionkey = event_id % 4) END AS job_title,
        lpad(user_id::VARCHAR, 14, '0') AS client_taxid, CASE WHEN event_id % 5 <> 0 THEN event_id END AS id_crm,
        CASE WHEN event_id % 2 = 0 THEN 'S' ELSE 'N' END AS is_primary
        FROM events WHERE user_id IN (SELECT c_custkey FROM customer)""",
    # ---- the two sides of the change sets ----------------------------------------------------------------
    "lead_a": f"""SELECT {', '.join(LEAD_DIFF_COLS)} FROM (
        SELECT * REPLACE (upper(name) AS name, lpad(taxid, 14, '0') AS taxid, upper(address_street) AS address_street,
            upper(address_complement) AS address_complement, upper(address_district) AS address_district,
            upper(city) AS city, upper(state) AS state) FROM leads) t
        SEMI JOIN (SELECT unnest(['Development/Budget', 'Activation', 'Retention/Expansion']) AS stage) synced USING (stage)""",
    "lead_b": f"""SELECT {', '.join(LEAD_DIFF_COLS)} FROM (
        SELECT * EXCLUDE (id), id_crm AS id, company_name AS name FROM (
            SELECT * REPLACE (upper(company_name) AS company_name, upper(address_street) AS address_street,
                upper(address_complement) AS address_complement, upper(address_district) AS address_district,
                upper(city) AS city, upper(state) AS state) FROM vw_crm_clients)) t
        SEMI JOIN leads USING (id)""",
    "contact_a": """SELECT id, upper(name) AS name, upper(email) AS email, phone, upper(job_title) AS job_title,
        ['N', 'S'][is_primary::INTEGER + 1] AS is_primary, client_code::BIGINT AS lead_id
        FROM contacts WHERE client_code::BIGINT IN (SELECT client_code FROM leads)""",
    "contact_b": """SELECT id_crm AS id, upper(name) AS name, upper(email) AS email, phone, upper(job_title) AS job_title,
        is_primary, (SELECT any_value(id_crm) FROM vw_base WHERE taxid = client_taxid) AS lead_id
        FROM vw_contacts WHERE id_crm IN (SELECT id FROM contacts)""",
    "stage_table": f"""SELECT i::BIGINT AS ordinal, {_STAGE_CANON}[i] AS canonical, {_STAGE_LIST}[i] AS alias
        FROM range(1, 9) t(i)""",
}


def with_standins(body: str) -> str:
    """Prefix a query with the stand-in CTEs it (transitively) uses."""
    import re
    names = list(STANDINS)
    used: set[str] = set()

    def visit(text: str) -> None:
        for n in names:
            if n not in used and re.search(rf"\b{n}\b", text):
                used.add(n)
                visit(STANDINS[n])
    visit(body)
    ctes = [f"{n} AS ({STANDINS[n]})" for n in names if n in used]
    if not ctes:
        return body
    head = "WITH " + ",\n".join(ctes)
    stripped = body.lstrip()
    if stripped[:15].upper() == "WITH RECURSIVE ":
        return "WITH RECURSIVE " + head[5:] + ",\n" + stripped[15:]
    if stripped[:5].upper() == "WITH ":
        return head + ",\n" + stripped[5:]
    return head + "\n" + body


# ---------------------------------------------------------------------------
# Query bodies, one per catalog key
# ---------------------------------------------------------------------------

def _long(side: str, fields: list[str]) -> str:
    """(id, field, value) of a side."""
    return (f"SELECT id, unnest([{', '.join(repr(c) for c in fields)}]) AS field, "
            f"unnest([{', '.join(f'{c}::VARCHAR' for c in fields)}]) AS value FROM {side}")


def _unlike(side: str, other: str, fields: list[str]) -> str:
    """Rows of ``side`` for which ``other`` has no row of the same id that agrees in every field (null with null)."""
    return f"""SELECT s.* FROM {side} s LEFT JOIN (
            SELECT x.id AS same_id, count(*) AS n FROM ({_long(side, fields)}) x JOIN ({_long(other, fields)}) y
            ON y.id = x.id AND y.field = x.field AND y.value IS NOT DISTINCT FROM x.value GROUP BY x.id) same
        ON same.same_id = s.id WHERE ifnull(same.n, 0) < {len(fields)}"""


ORACLE: dict[str, str] = {
    "scan_parquet": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'",
    "client_view": "SELECT * FROM vw_crm_clients",
    "insert_candidates": """SELECT company_name AS name, taxid, address_street AS address, address_district AS district,
        address_zipcode AS zipcode, address_number AS number, city, phone, address_complement AS complement, state,
        country, industry, sales_rep, client_code, tax_registration
        FROM vw_base b LEFT JOIN vw_industry i USING (client_code, branch_code)
        WHERE integrate_crm = 'Y' AND id_crm IS NULL""",
    # The chained set difference leaves the ERP's rows that the CRM has not.
    "lead_diff": _unlike("lead_b", "lead_a", LEAD_DIFF_COLS[1:]),
    "contact_view": "SELECT * FROM vw_contacts",
    "contact_diff": _unlike("contact_b", "contact_a", ["name", "email", "phone", "job_title", "is_primary", "lead_id"]),
    "budget_value": "SELECT * FROM vw_budget",
    "order_value": "SELECT * FROM vw_order",
    "has_order": """SELECT br.client AS client_code, br.code AS branch_code,
        CASE WHEN hit.key1 IS NULL THEN 'N' ELSE 'Y' END AS has_order
        FROM branches br LEFT JOIN (
            SELECT DISTINCT p.key1, p.key2 FROM sales_order_item it
            JOIN sales_order so ON so.company_code = it.so_company_code AND so.number = it.so_number
            JOIN person p ON p.code = so.pers_code
            WHERE it.item_date >= TIMESTAMP '1998-01-01') hit ON hit.key1 = br.client AND hit.key2 = br.code""",
    "has_retention": """SELECT client_code, branch_code, has_order, has_retention FROM vw_has_order""",
    "has_budget": """SELECT br.client AS client_code, br.code AS branch_code,
        CASE WHEN hit.c IS NULL THEN 'N' ELSE 'Y' END AS has_budget
        FROM branches br LEFT JOIN (
            SELECT DISTINCT b.client_billing_code AS c, b.branch_billing_code AS k FROM budget b
            JOIN budget_item bi ON bi.bdg_number = b.number
            WHERE bi.date >= TIMESTAMP '1998-01-01' AND bi.generated <> 'N') hit ON hit.c = br.client AND hit.k = br.code""",
    "has_service_order": """SELECT br.client AS client_code, br.code AS branch_code,
        CASE WHEN hit.c IS NULL THEN 'N' ELSE 'Y' END AS has_service_order
        FROM branches br LEFT JOIN (
            SELECT DISTINCT so.client AS c, so.branch AS k FROM service_order so
            JOIN service_order_item si ON si.soi_company_code = so.company_code AND si.soi_branch_code = so.branch_code
                 AND si.soi_sales_rep_code = so.sales_rep_code AND si.soi_number = so.number
            WHERE si.create_date >= TIMESTAMP '1998-01-01' AND si.status <> 'C') hit ON hit.c = br.client AND hit.k = br.code""",
    "latest_observation": "SELECT * FROM vw_fa",
    "min_industry": "SELECT * FROM vw_industry",
    "min_tier": """WITH lowest AS (SELECT bit_bdg_number, bit_item, min(quantity) AS lo FROM budget_item_quantity GROUP BY 1, 2)
        SELECT t.bit_bdg_number, t.bit_item, CAST(t.quantity AS DOUBLE) AS quantity
        FROM budget_item_quantity t JOIN lowest w ON w.bit_bdg_number = t.bit_bdg_number AND w.bit_item = t.bit_item
        WHERE t.quantity = w.lo""",
    "value_override": """SELECT b.client_code, b.branch_code,
        CASE WHEN b.client_code = 1001 THEN 10000.0 ELSE bv.budget_value END AS budget_value,
        CASE WHEN b.client_code = 1002 THEN 10000.0 ELSE ov.order_value END AS order_value
        FROM vw_base b LEFT JOIN vw_budget bv USING (client_code, branch_code)
        LEFT JOIN vw_order ov USING (client_code, branch_code)""",
    "budget_changes": """SELECT id, budget_value, taxid FROM (
            SELECT l.id, l.taxid, v.budget_value FROM vw_crm_clients v, leads l WHERE l.id = v.id_crm AND v.budget_value IS NOT NULL
            EXCEPT SELECT id, taxid, budget_value::DOUBLE FROM leads) unlike""",
    "sold_changes": """SELECT id_crm AS id, order_value, sales_rep_email FROM vw_crm_clients
        WHERE budget_value IS NOT NULL AND order_value IS NOT NULL
          AND id_crm IN (SELECT id FROM leads WHERE stage <> 'Activation')
          AND (id_crm, order_value) NOT IN (SELECT (id, coalesce(order_value::DOUBLE, -1)) FROM leads)""",
}


def oracle_queries() -> dict[str, str]:
    from . import oracle_more  # noqa: F401  (registers the remaining keys)
    return {k: with_standins(v) for k, v in ORACLE.items()}

STANDINS.update({
    "crm_export": f"""SELECT c_custkey AS id, CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE c_name END AS lead,
        CASE WHEN c_custkey % 41 = 5 THEN '99' || lpad(c_custkey::VARCHAR, 14, '0') WHEN c_custkey % 41 = 6 THEN '9' || lpad(c_custkey::VARCHAR, 14, '0')
             WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 7 = 3 THEN lpad((c_custkey + 90000000)::VARCHAR, 14, '0')
             ELSE lpad(c_custkey::VARCHAR, 14, '0') END AS cnpj,
        CASE WHEN c_custkey % 12 = 1
             THEN replace({_STAGE_CANON}[(CASE WHEN c_custkey % 10 = 0 AND c_custkey % 8 > 0 THEN c_custkey % 8 - 1 ELSE c_custkey % 8 END + 1)::INTEGER], ' ', chr(160))
             ELSE {_STAGE_CANON}[(CASE WHEN c_custkey % 10 = 0 AND c_custkey % 8 > 0 THEN c_custkey % 8 - 1 ELSE c_custkey % 8 END + 1)::INTEGER] END AS stage,
        {{'value': c_mktsegment}} AS industry,
        {{'value': CASE WHEN c_custkey % 2 = 0 THEN 'ERP' ELSE 'Site' END}} AS source,
        '55.11-9' || lpad(c_custkey::VARCHAR, 8, '0') AS phone1,
        'Rua ' || c_mktsegment || ' ' || c_nationkey::VARCHAR AS street,
        substr(lpad((c_custkey % 99991)::VARCHAR, 8, '0'), 1, 5) || '-' || substr(lpad((c_custkey % 99991)::VARCHAR, 8, '0'), 6, 3) AS cep,
        CASE WHEN c_custkey % 19 = 0 THEN 'SN' ELSE (c_custkey % 997)::VARCHAR END AS number,
        CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'Sala ' || (c_custkey % 50)::VARCHAR END AS complement,
        c_mktsegment AS district,
        CASE WHEN c_custkey % 4 = 2 THEN lower(n_name) ELSE n_name END AS city, r_name AS state
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE c_custkey % 6 <> 5""",
    "custom_field_rows": """SELECT * FROM (
        SELECT c_custkey AS leadId, 1 AS pos, '_cod.gestores' AS id, (c_custkey % 10)::VARCHAR AS value FROM customer WHERE c_custkey % 6 <> 5
        UNION ALL SELECT c_custkey, 2, '_inscricaoestadual', CASE WHEN c_custkey % 3 = 0 THEN 'ISENTO' WHEN c_custkey % 7 = 0 THEN '99'
            WHEN c_custkey % 11 = 0 THEN '0' ELSE '1.' || ((c_custkey * 7919) % 1000000)::VARCHAR END FROM customer WHERE c_custkey % 6 <> 5
        UNION ALL SELECT c_custkey, 3, '_analisefinanceira', CASE WHEN c_custkey % 2 = 0 THEN 'signup' ELSE 'credit ok' END FROM customer WHERE c_custkey % 6 <> 5
        UNION ALL SELECT c_custkey, 4, '_cod.cliente', c_custkey::VARCHAR FROM customer WHERE c_custkey % 6 <> 5
        UNION ALL SELECT c_custkey, 5, '_cod.gestores', (c_custkey % 7)::VARCHAR FROM customer WHERE c_custkey % 6 <> 5 AND c_custkey % 5 = 0
        ) t""",
    "sale_lines": """SELECT o_custkey AS lead_id, l_orderkey AS sale_id, l_linenumber::BIGINT AS line, l_partkey AS product_id,
        (CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE l_extendedprice END)::DECIMAL(18,2) AS final_value,
        o_orderdate AS sale_date FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
})

STANDINS.update({
    "crm_contacts": """SELECT event_id AS id, user_id AS leadId, 'Contact ' || event_id::VARCHAR AS name,
        CASE WHEN event_id % 9 = 0 THEN NULL ELSE 'u' || (event_id - CASE WHEN event_id % 4 = 3 THEN 1 ELSE 0 END)::VARCHAR || '@x.org' END AS email,
        '5521' || lpad(event_id::VARCHAR, 8, '0') AS phone1,
        CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'Buyer' END AS jobTitle,
        CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS mainContact
        FROM events""",
    "lead_docs": """SELECT c_custkey AS id, list_filter([
        {'id': '_cod.gestores', 'value': (c_custkey % 10)::VARCHAR},
        {'id': '_inscricaoestadual', 'value': CASE WHEN c_custkey % 3 = 0 THEN 'ISENTO' WHEN c_custkey % 7 = 0 THEN '99'
            WHEN c_custkey % 11 = 0 THEN '0' ELSE '1.' || ((c_custkey * 7919) % 1000000)::VARCHAR END},
        {'id': '_analisefinanceira', 'value': CASE WHEN c_custkey % 2 = 0 THEN 'signup' ELSE 'credit ok' END},
        {'id': '_cod.cliente', 'value': c_custkey::VARCHAR},
        {'id': '_cod.gestores', 'value': CASE WHEN c_custkey % 5 = 0 THEN (c_custkey % 7)::VARCHAR END}],
        lambda x: x.value IS NOT NULL) AS CustomFields
        FROM customer WHERE c_custkey % 6 <> 5""",
    "webhook_docs": f"""SELECT event_id AS doc_id, ts AS received_at, event_type AS kind, user_id AS lead_id,
        {_STAGE_CANON}[(event_id % 8 + 1)::INTEGER] AS stage,
        'Company ' || user_id::VARCHAR || ' ' || (event_id % 3)::VARCHAR
          || CASE WHEN event_id % 9 = 0 THEN ' Comercio Industria e Servicos Limitada' ELSE '' END AS company,
        '{{"Lead":{{"Id":' || user_id::VARCHAR
          || CASE WHEN event_id % 3 = 0 THEN ',"Company":"' || 'Company ' || user_id::VARCHAR || ' ' || (event_id % 3)::VARCHAR
               || CASE WHEN event_id % 9 = 0 THEN ' Comercio Industria e Servicos Limitada' ELSE '' END || '"' ELSE '' END
          || CASE WHEN event_id % 4 = 0 THEN ',"Phone":null' WHEN event_id % 4 = 1 THEN ',"Phone":"' || '5531' || lpad(event_id::VARCHAR, 8, '0') || '"' ELSE '' END
          || CASE WHEN event_id % 5 = 0 THEN ',"CpfCnpj":"' || lpad(user_id::VARCHAR, 14, '0') || '"' ELSE '' END
          || CASE WHEN event_id % 6 = 0 THEN ',"Address":{{"ZipCode":"' || substr(lpad((event_id % 99991)::VARCHAR, 8, '0'), 1, 5) || '-'
               || substr(lpad((event_id % 99991)::VARCHAR, 8, '0'), 6, 3) || '","City":"Cidade ' || (event_id % 25)::VARCHAR || '"}}' ELSE '' END
          || CASE WHEN event_id % 7 == 0 THEN ',"CustomFields":[{{"id":"_cod.gestores","value":"' || (event_id % 10)::VARCHAR
               || '"}},{{"id":"_cod.gestores","value":"x"}}]' ELSE '' END
          || ',"Stage":"' || {_STAGE_CANON}[(event_id % 8 + 1)::INTEGER] || '"}}}}' AS raw
        FROM events""",
    "webhook_contacts": """SELECT event_id AS doc_id, user_id AS lead_id, ts AS received_at, event_id * 10 + n AS contact_id,
        'Person ' || n::VARCHAR || ' of ' || event_id::VARCHAR AS contact_name,
        'p' || n::VARCHAR || '.' || event_id::VARCHAR || '@x.org' AS contact_email
        FROM events, (SELECT 1 AS n UNION ALL SELECT 2) t WHERE n = 1 OR event_id % 2 = 0""",
})
