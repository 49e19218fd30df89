"""Contact changes over two keys, in arrival order.

A change meets contacts by e-mail or by CRM id, and moves them from one CRM id to another, so changes of different
e-mails can depend on one another.  Changes and the contacts they can meet are therefore grouped into components of the
graph that their keys make; each component's events stream through one task in order, and components run side by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .components import components
from .quality import assign_ids

CONTACT = ["code", "name", "email", "phone", "job_title_desc", "branch_client", "is_primary", "id_crm"]


class _Group:
    """Contacts that share e-mail, CRM id and values: one each at first, one per e-mail once a change set them."""

    __slots__ = ("mail", "id", "values", "set_at", "members")

    def __init__(self, mail, id_crm, values: tuple, set_at: int, members: list) -> None:
        self.mail, self.id, self.values, self.set_at, self.members = mail, id_crm, values, set_at, members


class _Replay:
    """One component's contacts while its changes pass, each change in constant time (amortised)."""

    def __init__(self) -> None:
        self.by_mail: dict = {}
        self.by_id: dict = {}
        self.id_values: dict = {}  # CRM id: what a change last set for all that have it
        self.keyless: list[_Group] = []  # no change meets these
        self.now = 0

    def _put(self, g: _Group) -> None:
        if g.mail is None and g.id is None:
            self.keyless.append(g)
        for index, key in ((self.by_mail, g.mail), (self.by_id, g.id)):
            if key is not None:
                index.setdefault(key, {})[id(g)] = g

    def _drop(self, g: _Group) -> None:
        for index, key in ((self.by_mail, g.mail), (self.by_id, g.id)):
            if key is not None:
                del index[key][id(g)]

    def contact(self, r: _Row) -> None:
        self._put(_Group(r.mail, r.id_crm, (r.name, r.phone, r.title, r.is_primary), 0, [(r.code, r.email, r.client, None)]))

    def change(self, r: _Row) -> None:
        self.now += 1
        same_mail, same_id = self.by_mail.get(r.mail), self.by_id.get(r.id_crm)
        if r.op == "D":
            for g in {**(same_mail or {}), **(same_id or {})}.values():
                self._drop(g)
        elif r.client is None:
            return
        elif same_mail:
            values = (r.name, r.phone, r.title_upper, r.is_primary)
            met = list(same_mail.values())
            members = met[0].members if len(met) == 1 else [m for g in met for m in g.members]
            for g in met:
                self._drop(g)
            self._put(_Group(r.mail, r.id_crm, values, self.now, members))
            if r.id_crm is not None:
                self.id_values[r.id_crm] = self.now, values
        elif not same_id:
            self._put(_Group(r.mail, r.id_crm, (r.name, r.phone, r.title, r.is_primary), self.now, [(None, r.mail, r.client, r.at)]))

    def contacts(self) -> Iterator[tuple]:
        """Rows of CONTACT and ``at``."""
        groups = {i: g for index in (self.by_mail, self.by_id) for some in index.values() for i, g in some.items()}
        for g in [*groups.values(), *self.keyless]:
            at, values = self.id_values.get(g.id, (-1, None))
            name, phone, title, primary = values if at > g.set_at else g.values
            for code, email, owner, arrived in g.members:
                yield code, name, email, phone, title, owner, primary, g.id, arrived


class _Row(NamedTuple):
    """A contact (kind 0) or a change (kind 1) as it streams, in this order of columns."""

    component: int
    kind: int
    at: int | None
    code: int | None
    name: str | None
    email: str | None
    mail: str | None
    phone: str | None
    title: str | None
    title_upper: str | None
    client: int | None
    is_primary: str | None
    id_crm: int | None
    op: str | None


def _replayed(schema: pa.Schema):
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        component, replay, out = None, _Replay(), []
        for batch in batches:
            for r in map(_Row._make, zip(*[c.to_pylist() for c in batch.columns])):
                if r.component != component:
                    out += replay.contacts()
                    component, replay = r.component, _Replay()
                (replay.contact if r.kind == 0 else replay.change)(r)
            if out:
                yield batch_of(out)
                out = []
        yield batch_of([*out, *replay.contacts()])
    return run


def _key(kind: str, c: Column) -> Column:
    return F.when(c.isNotNull(), F.xxhash64(F.lit(kind), c))  # two keys of one hash only share a component


def contacts_changed(target: DataFrame, changes: DataFrame, order: str = "id_crm") -> tuple[DataFrame, DataFrame, DataFrame]:
    """What changes do to the contacts they meet: (the contacts they meet, as they were; those and new ones afterwards, new
    ones without a code and with ``at``, the change that inserted them; the contacts that no change meets)."""
    title = F.col("job_title")
    events = changes.select(
        F.lit(None).cast("bigint").alias("code"), "name", "email", "phone", title.alias("job_title_desc"), F.col("client").cast("bigint").alias("branch_client"),
        "is_primary", F.col("id_crm").cast("bigint").alias("id_crm"), F.col("op").alias("op"),
        F.col(order).cast("bigint").alias("at"), F.lit(1).alias("kind"),
        _key("mail", F.lower("email")).alias("_m"), _key("id", F.col("id_crm").cast("bigint")).alias("_i"))
    keys = cut_lineage(events.select(F.explode(F.array_compact(F.array("_m", "_i"))).alias("key")).distinct())
    known = target.select(
        *CONTACT, _key("mail", F.lower("email")).alias("_m"),
        _key("id", F.col("id_crm").cast("bigint")).alias("_i"))
    for c in ("_m", "_i"):  # only keys that some change has matter
        known = known.join(keys.select(F.col("key").alias(c), F.lit(True).alias(f"{c}_met")), c, "left")
    met = F.col("_m_met").isNotNull() | F.col("_i_met").isNotNull()
    touched = cut_lineage(known.where(met).select(*CONTACT, F.when(F.col("_m_met"), F.col("_m")).alias("_m"),
                                                  F.when(F.col("_i_met"), F.col("_i")).alias("_i")))
    pairs = events.select("_m", "_i").unionByName(touched.select("_m", "_i"))
    of = components(pairs.where("_m IS NOT NULL AND _i IS NOT NULL").select(F.col("_m").alias("a"), F.col("_i").alias("b")))

    def placed(df: DataFrame) -> DataFrame:
        key = F.coalesce("_m", "_i")
        j = df.withColumn("_k", key).join(of.withColumnRenamed("node", "_k"), "_k", "left")
        return j.withColumn("component", F.coalesce("component", "_k", F.xxhash64(F.lit("none"), "at"))).drop("_k", "_m", "_i")

    old = touched.select("*", F.lit(None).cast("string").alias("op"), F.lit(None).cast("bigint").alias("at"), F.lit(0).alias("kind"))
    columns = ["component", "kind", "at", "code", "name", "email", "mail", "phone", "job_title_desc", "title_upper", "branch_client",
               "is_primary", "id_crm", "op"]  # as in _Row
    stream = placed(old).unionByName(placed(events.where("op IS NULL OR op <> 'D' OR _m IS NOT NULL OR _i IS NOT NULL")))
    out = ", ".join(f"{c} {target.schema[c].dataType.simpleString()}" for c in CONTACT) + ", at bigint"
    dealt = stream.repartition("component").sortWithinPartitions("component", "kind", "at", "code")
    derived = {"mail": F.lower("email"), "title_upper": F.upper("job_title_desc")}  # behind the sort: neither dealt nor spilled
    replayed = dealt.withColumns(derived).select(*columns).mapInArrow(_replayed(_arrow(target)), out)
    replayed = cut_lineage(replayed)
    return touched.select(*CONTACT), replayed, known.where(~met).select(*CONTACT)


def contact_merge(target: DataFrame, changes: DataFrame, order: str = "id_crm") -> DataFrame:
    """Contact upsert/delete, in the arrival order of the changes.

    ``target``: the columns CONTACT; ``changes``: (client, name, email, phone, job_title, is_primary, id_crm, op) and
    ``order``, a unique long.  Op 'D' deletes the contacts that have the CRM id or the lower-case e-mail at that time.
    Any other op needs a client: where contacts have the e-mail, they and those with the CRM id get the change's values
    and CRM id; else (also without an e-mail) a contact is inserted, unless its CRM id is there (M15).  Codes of
    inserted contacts go on from the greatest, in the order of arrival.

    A component's events pass through one task as a sorted stream; held in memory are its contacts alone, and a change
    takes constant time, so a component with a third of the changes is a task that reads as much, no more.
    """
    _, replayed, untouched = contacts_changed(target, changes, order)
    kept = untouched.unionByName(replayed.where("code IS NOT NULL").select(*CONTACT))
    start = target.agg(F.coalesce(F.max("code"), F.lit(0)).cast("bigint")).scalar()
    fresh = assign_ids(replayed.where("code IS NULL").drop("code"), start, ["at"], "code")
    return kept.unionByName(fresh.select(*CONTACT))


def _arrow(target: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    fields = to_arrow_schema(target.select(*CONTACT).schema)
    return pa.schema([*[pa.field(f.name, f.type) for f in fields], ("at", pa.int64())])
