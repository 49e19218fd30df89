"""Tables that change together, ids over micro-batches, and the cascade as a stream: cut off, replayed, restarted."""

import itertools

import pytest

from recordsync.streaming import ingest as I
from recordsync.streaming.cascade import CascadeSink
from recordsync.streaming.epochs import EpochTables, IdLedger


class Cut(Exception):
    pass


def cut_after(monkeypatch, n):
    """The n-th table write of an epoch is the last before the job dies."""
    calls, plain = itertools.count(), EpochTables.write_table  # counted before they start: several run at once

    def write(rows, path):
        if next(calls) >= n:
            raise Cut
        plain(rows, path)
    monkeypatch.setattr(EpochTables, "write_table", staticmethod(write))


def test_epoch_is_all_or_nothing(spark, tmp_path, monkeypatch):
    tables = EpochTables(str(tmp_path))
    a, b = spark.createDataFrame([(1,)], "x long"), spark.createDataFrame([(2,)], "y long")
    assert tables.read(spark, "a", a.schema).count() == 0
    with monkeypatch.context() as m:
        cut_after(m, 1)
        with pytest.raises(Cut):
            tables.write(spark, 0, {"a": a, "b": b})
    assert tables.read(spark, "a", a.schema).count() == 0  # written, but not of an epoch that counts
    assert tables.write(spark, 0, {"a": a, "b": b})
    assert not tables.write(spark, 0, {"a": a, "b": b})  # a replay
    assert tables.write(spark, 1, {"a": a})
    assert sorted(map(tuple, tables.read(spark, "a", a.schema).collect())) == [(1, 0), (1, 1)]
    assert [tuple(r) for r in tables.read(spark, "b", b.schema).collect()] == [(2, 0)]
    assert [tuple(r) for r in EpochTables(str(tmp_path)).read(spark, "a", a.schema, before=1).collect()] == [(1, 0)]


def test_id_ledger(spark, tmp_path):
    ledger = IdLedger(str(tmp_path), "client", 41)
    assert ledger.claim(spark, 0, 3) == 41
    assert ledger.claim(spark, 1, 0) == 44
    assert ledger.claim(spark, 2, 2) == 44
    again = IdLedger(str(tmp_path), "client", 41)  # a restart
    assert [again.claim(spark, e, n) for e, n in ((0, 3), (2, 2), (3, 1))] == [41, 44, 46]
    with pytest.raises(ValueError, match="not the same rows"):
        again.claim(spark, 2, 5)
    assert IdLedger(str(tmp_path), "log", 0).claim(spark, 7, 1) == 0


LEAD = ("id long, name string, stage string, taxid string, industry string, source string, phone string, address_street string, "
        "address_zipcode string, address_number int, address_complement string, address_district string, city string, "
        "state string, sales_rep long, tax_registration string, financial_analysis string")
VIEW = ("id string, client_code long, branch_code long, company_name string, taxid string, sales_rep long, city_code long, "
        "address_zipcode string, address_street string, address_number int, address_district string, address_complement string, "
        "tax_registration string, phone string, id_crm long, integrate_crm string, industry string")


def lead(i, taxid, **more):
    row = dict(id=i, name=f"Firm {i}", stage="Activation", taxid=taxid, industry="Steel", source="Site", phone="1", address_street="Rua A",
               address_zipcode="1", address_number=1, address_complement=None, address_district="Centro", city="Lima", state="Sul",
               sales_rep=3, tax_registration=None, financial_analysis="ok")
    return tuple((row | more).values())


@pytest.fixture
def erp(spark, tmp_path):
    view = spark.createDataFrame([("7-1", 7, 1, "Old", "00000000000700", 3, 1, "1", "Rua A", 1, "Centro", None, "R", "1", None, "N", "Wood")], VIEW)
    branches = spark.createDataFrame([(7, 1, "00000000000700")], "client long, code long, taxid string")
    cities = spark.createDataFrame([(1, 1, "Lima", 5, "US")], "id long, city_code long, city_name string, state_code long, country_code string")
    states = spark.createDataFrame([(5, "Sul")], "code long, name string")
    history = spark.createDataFrame([(7, 4)], "client_code long, sequence long")
    trades = spark.createDataFrame([(1, "Wood"), (2, "Steel"), (3, "steel")], "industry long, description string")

    def sink(root="erp"):
        return CascadeSink(str(tmp_path / root), view, branches, cities, states, history, trades)
    return sink


def batches():
    return [[lead(100, "700", phone="2"), lead(101, "800"), lead(102, "800"), lead(103, "9" * 15), lead(104, "9" * 16), lead(105, None)],
            [lead(106, "800", phone="9", financial_analysis="better"), lead(107, "900"), lead(108, "850", financial_analysis=None)],
            [], [lead(109, "900", industry="Wood"), lead(110, "10")]]


def state(sink, spark):
    return {name: sorted(map(tuple, rows.collect()), key=repr) for name in
            ("branches", "clients", "sales_rep_branches", "billing_addresses", "credit_limit_history", "client_industries",
             "branch_updates", "industry_updates", "rejects") if (rows := sink.table(spark, name)) is not None}


def test_cascade_over_epochs(spark, erp):
    sink = erp()
    for epoch, rows in enumerate(batches()):
        sink(spark.createDataFrame(rows, LEAD), epoch)
    got = state(sink, spark)
    new = {r.taxid: (r.client, r.epoch, r.id_crm) for r in sink.table(spark, "branches").collect()}
    assert new == {"00000000000800": (8, 0, 101), "00000000000850": (9, 1, 108), "00000000000900": (10, 1, 107),
                   "00000000000010": (11, 3, 110)}
    assert [tuple(r)[:2] for r in got["rejects"]] == [(103, "9" * 15), (104, "9" * 16)]
    updates = {r.lead_id: (r.client, r.phone, r.id_crm) for r in sink.table(spark, "branch_updates").collect()}
    assert updates == {100: (7, "2", 100), 106: (8, "9", 101), 109: (10, "1", 107)}
    history = sorted((r.client_code, r.sequence, r.observations) for r in sink.table(spark, "credit_limit_history").collect())
    assert history == [(7, 5, "ok"), (8, 1, "ok"), (8, 2, "better"), (10, 1, "ok"), (10, 2, "ok"), (11, 1, "ok")]
    assert [(r.client, r.industry, r.epoch) for r in sink.table(spark, "industry_updates").orderBy("epoch").collect()] == [(7, 2, 0), (10, 1, 3)]
    view = {r.client_code: (r.phone, r.id_crm, r.industry) for r in sink.clients_before(spark).collect()}
    assert view[7] == ("2", 100, "Steel") and view[8] == ("9", 101, "Steel") and view[10][2] == "Wood"


def test_cascade_cut_between_two_tables_and_replayed(spark, erp, monkeypatch):
    whole, broken = erp("whole"), erp("broken")
    for epoch, rows in enumerate(batches()[:2]):
        df = spark.createDataFrame(rows, LEAD)
        whole(df, epoch)
        before = state(broken, spark)
        with monkeypatch.context() as m:
            cut_after(m, epoch + 2)
            with pytest.raises(Cut):
                broken(df, epoch)
        assert state(broken, spark) == before  # nobody sees part of the epoch
        broken = erp("broken")  # another driver
        broken(df, epoch)
        broken(df, epoch)
        assert state(broken, spark) == state(whole, spark)


def test_cascade_stream_restarts(spark, erp, tmp_path):
    queue = str(tmp_path / "queue")
    for n, rows in enumerate(batches()):
        spark.createDataFrame(rows, LEAD).coalesce(1).write.mode("append").json(queue)
        sink = erp("stream")
        stream = I.read_queue(spark, queue, schema=spark.createDataFrame([], LEAD).schema)
        I.start_sync(stream, str(tmp_path / "ckpt"), sink).awaitTermination()
    got = sorted((r.client, r.taxid) for r in sink.table(spark, "branches").collect())
    assert got == [(8, "00000000000800"), (9, "00000000000850"), (10, "00000000000900"), (11, "00000000000010")]
