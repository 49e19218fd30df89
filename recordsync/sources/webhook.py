"""CRM webhook lead documents: which fields a document may set (M2).

A document only carries the keys that changed.  For every lead column the
map below gives the JSON object that holds the key, the key, and how the
value is shaped on the way in; presence is read from the raw text, so a key
that is present with ``null`` sets NULL while an absent key leaves the
column alone.  Custom fields count as present only when their value is
truthy (the first entry with the id is used).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import nbsp_to_space, strip_punct, truncate
from ..schemas import (CF_CLIENT_CODE, CF_FINANCIAL_ANALYSIS, CF_SALES_REP, CF_TAX_REGISTRATION, LEAD_KEYS, STAGES_ALIAS,
                       STAGES_CANONICAL, SYNCED_STAGES)

SYNCED_CANONICAL = [STAGES_CANONICAL[STAGES_ALIAS.index(s)] for s in SYNCED_STAGES]

# lead column -> custom field id
LEAD_CUSTOM = {
    "sales_rep": CF_SALES_REP,
    "tax_registration": CF_TAX_REGISTRATION,
    "client_code": CF_CLIENT_CODE,
    "financial_analysis": CF_FINANCIAL_ANALYSIS,
}
NUMERIC = {"sales_rep", "client_code"}


def stage_alias(c: Column) -> Column:
    m = F.create_map(*[x for a, b in zip(STAGES_CANONICAL, STAGES_ALIAS) for x in (F.lit(a), F.lit(b))])
    return F.try_element_at(m, nbsp_to_space(c))


def doc_stage(raw: Column) -> Column:
    return nbsp_to_space(F.get_json_object(raw, "$.Lead.Stage"))


def is_synced(raw: Column) -> Column:
    """Only documents of leads in the synced stages are applied."""
    return F.coalesce(doc_stage(raw).isin(*SYNCED_CANONICAL), F.lit(False))


# Typed view of the fields a lead document may carry (values parsed once).
LEAD_DOC_TYPE = ("struct<Lead:struct<Stage:string,CpfCnpj:string,Industry:struct<value:string>,"
                 "Origin:struct<value:string>,Phone:string,Company:string,"
                 "Address:struct<ZipCode:string,AddAddressInformation:string,City:string,State:string>,"
                 "CustomFields:array<struct<id:string,value:string>>>>")


def _keys(text: Column) -> Column:
    """Key -> raw value text of a JSON object (keys with a null value kept)."""
    return F.from_json(text, "map<string,string>")


def lead_update_fields(raw: Column) -> dict[str, tuple[Column, Column]]:
    """Column -> (new value, present) for one raw webhook document.

    The document is parsed once into a typed struct for the values and once
    into a key map of ``Lead`` for presence (nested objects come back as
    their JSON text and are key-mapped in turn), instead of one JSON scan
    per field.
    """
    doc = F.from_json(raw, LEAD_DOC_TYPE)["Lead"]
    lead_keys = F.from_json(raw, "struct<Lead:map<string,string>>")["Lead"]
    parents = {"$.Lead": lead_keys}
    for sub in ("Industry", "Origin", "Address"):
        parents[f"$.Lead.{sub}"] = _keys(F.try_element_at(lead_keys, F.lit(sub)))
    out: dict[str, tuple[Column, Column]] = {}
    for col, (parent, key) in LEAD_KEYS.items():
        node = doc
        for part in parent.split(".")[2:]:
            node = node[part]
        v = node[key]
        if col == "name":
            v = truncate(v, 40)
        elif col == "address_zipcode":
            v = strip_punct(v)
        elif col == "stage":
            v = stage_alias(v)
        present = F.coalesce(F.map_contains_key(parents[parent], F.lit(key)), F.lit(False))
        out[col] = (v, present)
    cfs = doc["CustomFields"]
    for col, fid in LEAD_CUSTOM.items():
        v = F.try_element_at(F.filter(cfs, lambda x: x["id"] == F.lit(fid)), F.lit(1))["value"]
        present = F.coalesce(v.isNotNull() & (v != ""), F.lit(False))
        out[col] = (v.try_cast("bigint") if col in NUMERIC else v, present)
    return out
