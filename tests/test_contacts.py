"""Contact merge against a plain replay, change by change, and components against union-find."""

import random

import pytest
from pyspark.sql import functions as F

from recordsync.operators import components as components_module
from recordsync.operators.components import components
from recordsync.operators.contacts import CONTACT, contact_merge

TARGET = ("code bigint, name string, email string, phone string, job_title_desc string, branch_client bigint, "
          "is_primary string, id_crm bigint")
CHANGES = ("seq bigint, client bigint, name string, email string, phone string, job_title string, is_primary string, "
           "id_crm bigint, op string")


def plain(target, changes):
    now = [list(r) for r in target]
    for _, client, name, email, phone, title, prim, id_crm, op in sorted(changes):
        mail = email.lower() if email is not None else None
        same_mail = [c for c in now if mail is not None and c[2] is not None and c[2].lower() == mail]
        same_id = [c for c in now if id_crm is not None and c[7] == id_crm]
        if op == "D":
            now = [c for c in now if not any(c is x for x in same_mail + same_id)]
        elif client is not None and same_mail:
            for c in same_mail + same_id:
                c[1], c[3], c[4], c[6], c[7] = name, phone, title.upper() if title is not None else None, prim, id_crm
        elif client is not None and not same_id:
            now.append([None, name, mail, phone, title, client, prim, id_crm])
    return now


def merged(spark, target, changes):
    out = contact_merge(spark.createDataFrame(target, TARGET), spark.createDataFrame(changes, CHANGES), "seq")
    assert out.columns == CONTACT
    return sorted((tuple(r) for r in out.collect()), key=repr)


def expected(target, changes):
    got = plain(target, changes)
    code = max((r[0] for r in target), default=0)
    for c in got:  # in the order of arrival
        if c[0] is None:
            code += 1
            c[0] = code
    return sorted((tuple(c) for c in got), key=repr)


ONE = (10, "Ann", "a@a", "1", "T", 1, "S", 9)


@pytest.mark.parametrize("target,changes", [
    ([ONE], [(1, 1, "x", None, None, None, "N", 9, "D"), (2, 2, "new", "A@a", "5", "dev", "S", 4, "A")]),
    ([], [(1, 1, "x", "n@n", "5", "dev", "N", 7, "A"), (2, 1, "x", None, None, None, "N", 7, "D")]),
    ([], [(1, 1, "x", None, "5", "dev", "N", 7, "A"), (2, 1, "y", None, "6", "dev", "N", 7, "A")]),
    ([], [(1, 1, "x", "e@e", "5", "dev", "N", 7, "A"), (2, 1, "y", "f@f", "6", "dev", "N", 7, None)]),
    ([ONE, (11, "Bob", "b@b", "2", "T", 1, "N", 9)], [(1, 3, "both", "a@a", "5", "dev", "N", 9, "A"), (2, 3, "one", "B@b", "6", None, "N", 8, "A"),
                                                      (3, None, "gone", "a@a", None, None, None, 8, "D")]),
    ([ONE], [(1, None, "no client", "a@a", "5", "dev", "N", 9, "A"), (2, 3, None, None, None, None, None, None, "A"),
             (3, 3, "k", None, None, None, None, None, "A"), (4, 3, "k", None, None, None, None, None, "D")]),
    ([], []), ([ONE], [])])
def test_contact_merge_in_order(spark, target, changes):
    assert merged(spark, target, changes) == expected(target, changes)


@pytest.mark.parametrize("bound", [0, 500_000])
def test_contact_merge_is_a_plain_replay(spark, monkeypatch, bound):
    """10,000 batches at once, each with keys of its own."""
    monkeypatch.setattr(components_module, "IN_ONE_TASK", bound)
    rnd = random.Random(7)
    target, changes, want = [], [], []
    for b in range(10_000):
        def mail(up=False, b=b):
            m = rnd.choice([None, f"p{b}@x", f"q{b}@x", f"r{b}@x"])
            return m.upper() if up and m and rnd.random() < 0.3 else m

        def number(b=b):
            return rnd.choice([None, 10 * b, 10 * b + 1, 10 * b + 2])
        mine = [(100 * b + i, f"t{i}", mail(), "0", "T", i, "S", number()) for i in range(rnd.randrange(5))]
        asked = [(100 * b + i, rnd.choice([None, 1, 2, 3]), f"n{i}", mail(True), str(i), rnd.choice([None, "dev"]), "N", number(),
                  rnd.choice(["A", "A", None, "D"])) for i in range(rnd.randrange(7))]
        want += [tuple(c[1:]) for c in plain(mine, asked)]
        target += mine
        changes += asked
    got = contact_merge(spark.createDataFrame(target, TARGET), spark.createDataFrame(changes, CHANGES), "seq").collect()
    assert sorted((tuple(r)[1:] for r in got), key=repr) == sorted(want, key=repr)
    assert len({r.code for r in got}) == len(got)


def test_contact_merge_of_one_hot_address(spark):
    """A third of the changes on one address, and many contacts of one CRM id."""
    target = [(i, f"t{i}", "hot@x" if i % 2 else f"c{i}@x", "0", "T", 1, "S", 5) for i in range(3000)]
    changes = [(i, 1, f"n{i}", "hot@x" if i % 3 == 0 else f"c{i % 3000}@x", "1", "dev", "N", 5 if i % 7 else i, "D" if i % 97 == 96 else "A")
               for i in range(6000)]
    assert merged(spark, target, changes) == expected(target, changes)


@pytest.mark.parametrize("bound", [0, 500_000])
def test_components_are_union_find(spark, monkeypatch, bound):
    monkeypatch.setattr(components_module, "IN_ONE_TASK", bound)
    rnd = random.Random(3)
    edges = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [
        (2000, 2001 + i) for i in range(500)] + [(5, 5), (3000, 3000)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        if a != b:
            ra, rb = find(a), find(b)
            root[max(ra, rb)] = min(ra, rb)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {x: find(x) for x in root} and len(got) == len(root)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_contact_stream_is_a_plain_replay(spark, tmp_path, monkeypatch):
    """Micro-batches, one of them replayed and one cut off, give what all changes at once give; codes never come twice."""
    from recordsync.streaming.contacts import ContactSink
    from recordsync.streaming.epochs import EpochTables
    rnd = random.Random(9)
    mails, ids = [None, *[f"m{i}@x" for i in range(8)]], [None, *range(8)]
    target = [(i, f"t{i}", rnd.choice(mails), "0", "T", i, "S", rnd.choice(ids)) for i in range(12)]
    changes = [(i, 1, f"n{i}", rnd.choice(mails), str(i), "dev", "N", rnd.choice(ids), rnd.choice("AAAD")) for i in range(90)]
    base = spark.createDataFrame(target, TARGET)
    codes: set[int] = set()
    for epoch in range(3):
        batch = spark.createDataFrame(changes[epoch * 30:epoch * 30 + 30], CHANGES)
        if epoch == 1:
            with monkeypatch.context() as m:
                m.setattr(EpochTables, "write_table", staticmethod(lambda rows, path: 1 / 0))
                with pytest.raises(ZeroDivisionError):
                    ContactSink(str(tmp_path), base, "seq")(batch, epoch)
        sink = ContactSink(str(tmp_path), base, "seq")
        sink(batch, epoch)
        sink(batch, epoch)
        now = sink.current(spark).collect()
        assert sorted((tuple(r)[1:] for r in now), key=repr) == sorted(
            (tuple(c[1:]) for c in plain(target, changes[:epoch * 30 + 30])), key=repr)
        assert len({r.code for r in now}) == len(now)
        fresh = {r.code for r in now if r.code > 11} - codes
        assert not codes or not fresh or min(fresh) > max(codes)
        codes |= fresh


def test_derived_columns_are_not_written(spark, monkeypatch):
    """Lower-case e-mails and upper-case titles follow from other columns: they are made behind the last shuffle."""
    from recordsync.operators import contacts as C
    cut, seen = C.cut_lineage, []
    monkeypatch.setattr(C, "cut_lineage", lambda df: seen.append(df.columns) or cut(df))
    target = spark.createDataFrame([(1, "A", "a@x", None, None, 1, "S", 5)], _schema_of(C.CONTACT))
    changes = spark.createDataFrame(
        [(1, 1, "B", "A@x", None, "Boss", "N", 6, "A")],
        "seq long, client long, name string, email string, phone string, job_title string, is_primary string, id_crm long, op string")
    _, after, _ = C.contacts_changed(target, changes, "seq")
    assert [(r.code, r.name, r.job_title_desc, r.id_crm) for r in after.collect()] == [(1, "B", "BOSS", 6)]
    assert seen and not any({"mail", "title_upper"} & set(columns) for columns in seen)


def _schema_of(columns):
    longs = {"code", "branch_client", "id_crm"}
    return ", ".join(f"{c} {'long' if c in longs else 'string'}" for c in columns)
