"""Nested-field helpers (arrays of structs, JSON text).

Built from higher-order functions (``filter``, ``transform``) so a lookup in
an array stays a per-row expression, with no explode + regroup shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def custom_field(arr, field_id: str, value_field: str = "value") -> Column:
    """Value of the last element whose ``id`` equals ``field_id``.

    ``try_element_at(.., -1)`` gives NULL when nothing matches (plain
    ``element_at`` fails under ANSI) and keeps "last one wins" on repeats.
    """
    hit = F.try_element_at(F.filter(_c(arr), lambda x: x["id"] == F.lit(field_id)), F.lit(-1))
    return hit[value_field]


def custom_fields_to_map(arr) -> Column:
    """Deduplicated id -> value map (last wins), safe on repeated ids."""
    a = _c(arr)
    ids = F.array_distinct(F.transform(a, lambda x: x["id"]))
    return F.map_from_arrays(ids, F.transform(ids, lambda i: F.try_element_at(
        F.filter(a, lambda x: x["id"] == i), F.lit(-1))["value"]))


def split_custom(entries, prefix: str = "_") -> tuple[Column, Column]:
    """Split an array of (key, value) entries into plain and custom
    (key starting with ``prefix``) parts."""
    e = _c(entries)
    custom = F.filter(e, lambda x: x["key"].startswith(prefix))
    plain = F.filter(e, lambda x: ~x["key"].startswith(prefix))
    return plain, custom


def append_custom_field(arr, field_id: str, value) -> Column:
    """Append ``{id, value}`` to a custom-field array (NULL array -> new array)."""
    v = value if isinstance(value, Column) else F.lit(value)
    item = F.struct(F.lit(field_id).alias("id"), v.cast("string").alias("value"))
    return F.when(_c(arr).isNull(), F.array(item)).otherwise(F.array_append(_c(arr), item))


def json_key_present(raw, path: str, key: str) -> Column:
    """M2: whether ``key`` is present in the JSON object at ``path`` of ``raw``
    text, even when its value is null (a parsed struct loses that)."""
    keys = F.json_object_keys(F.get_json_object(_c(raw), path))
    return F.coalesce(F.array_contains(keys, F.lit(key)), F.lit(False))


def main_contact_flag(contacts, contact_id, id_field: str = "id", flag_field: str = "mainContact") -> Column:
    """N8: 'S' when the contact with ``contact_id`` is marked main in the
    lead's contact array (flag text 'true'), else 'N'."""
    cid = contact_id if isinstance(contact_id, Column) else F.lit(contact_id)
    hit = F.exists(_c(contacts), lambda x: (x[id_field] == cid) & (F.lower(x[flag_field].cast("string")) == "true"))
    return F.when(F.coalesce(hit, F.lit(False)), F.lit("S")).otherwise(F.lit("N"))
