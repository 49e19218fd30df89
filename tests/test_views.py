import datetime as dt

from recordsync.plans import views as V
from recordsync.sources.standins import DomainTables


class Fixture(DomainTables):
    """Domain tables injected directly (cached_property slots)."""

    def __init__(self, spark, **tables):
        super().__init__(spark, "/nonexistent")
        self.__dict__.update(tables)


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_order_value_window_and_presence(spark):
    base = "1998-01-01 12:00:00"  # base keeps its time: items of the base day fall outside (Q10)
    items = spark.createDataFrame([
        (1, 10, 1, 2.0, ts("1998-01-01 18:00:00")),   # base day: TRUNC -> 00:00 < base -> out
        (1, 10, 2, 1.0, ts("1998-01-02 00:00:00")),   # in
        (1, 10, 3, 1.0, ts("1999-01-01 00:00:00")),   # base + 365 days (day 1999-01-01 < 12:00) -> in
        (1, 10, 4, 5.0, ts("1999-01-02 09:00:00")),   # after the window -> out
        (1, 11, 1, 1.0, ts("1998-03-01 00:00:00")),   # other client, delivery not billed
    ], "so_company_code bigint, so_number bigint, sequence int, item_qty double, item_date timestamp_ntz")
    deliv = spark.createDataFrame([(1, 10, s, 10.0, "Y") for s in (1, 2, 3, 4)] + [(1, 11, 1, 10.0, "N")],
                                  "sod_company_code bigint, sod_number bigint, sequence int, unit_value double, "
                                  "billing_client string")
    so = spark.createDataFrame([(1, 10, 100), (1, 11, 200)], "company_code bigint, number bigint, pers_code bigint")
    person = spark.createDataFrame([(100, 100, 1), (200, 200, 1)], "code bigint, key1 bigint, key2 bigint")
    branches = spark.createDataFrame([(100, 1), (200, 1), (300, 1)], "client bigint, code bigint")
    t = Fixture(spark, sales_order_item=items, sales_order_item_delivery=deliv, sales_order=so, person=person,
                branches=branches)
    got = {r.client_code: r.order_value for r in V.order_value(t, base).collect()}
    assert got == {100: 20.0}
    pres = {r.client_code: (r.has_order, r.has_retention) for r in V.order_presence(t, base).collect()}
    assert pres == {100: ("Y", "Y"), 200: ("Y", "Y")}
    ho = {r.client_code: r.has_order for r in V.has_order(t, "1999-06-01 00:00:00").collect()}
    assert ho == {100: "N", 200: "N", 300: "N"}


def test_latest_observation_ties_and_nulls(spark):
    h = spark.createDataFrame([
        (1, dt.date(2020, 1, 1), "zz"), (1, dt.date(2021, 1, 1), "a"), (1, dt.date(2021, 1, 1), "b"),
        (2, dt.date(2021, 1, 1), None), (2, dt.date(2020, 1, 1), "old"),
        (3, None, "no date"),
    ], "client_code bigint, date date, observations string")
    got = {r.client_code: r.financial_analysis for r in V.latest_observation(Fixture(spark, credit_limit_history=h)).collect()}
    assert got == {1: "b", 2: None}


def test_min_tier_keeps_ties(spark):
    q = spark.createDataFrame([(1, "A", 5.0), (1, "A", 5.0), (1, "A", 9.0), (1, "B", 7.0)],
                              "bit_bdg_number bigint, bit_item string, quantity double")
    got = sorted(tuple(r) for r in V.min_tier(Fixture(spark, budget_item_quantity=q)).collect())
    assert got == [(1, "A", 5.0), (1, "A", 5.0), (1, "B", 7.0)]


def test_override(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1001, 5.0), (7, None)], "c bigint, v double")
    got = [r[0] for r in df.select(V.with_override(F.col("c"), F.col("v"), {1001: 10000})).collect()]
    assert got == [10000.0, None]


def test_staged_tables_give_same_results(spark, tmp_path):
    """Staging the derived domain tables does not change any result."""
    from conftest import SMOKE
    from recordsync.plans import catalog
    from recordsync.sources.standins import stage
    import __spark_entry__ as E
    keys = ["lead_diff", "budget_value", "contact_merge", "field_diff"]
    before = {k: sorted(map(tuple, E.queries()[k](spark, SMOKE).collect())) for k in keys}
    t = DomainTables(spark, SMOKE)
    t = stage(t, str(tmp_path / "staged"), partitions=3)
    builders = {k: catalog._REGISTRY[k] for k in keys}
    for k in keys:
        assert sorted(map(tuple, builders[k](t).collect())) == before[k], k


def test_lead_diff_synced_only_is_subset(spark):
    from conftest import SMOKE
    t = DomainTables(spark, SMOKE)
    full = set(map(tuple, V.lead_diff(t).collect()))
    synced = set(map(tuple, V.lead_diff(t, synced_only=True).collect()))
    assert synced <= full and len(synced) < len(full)


def test_client_cascade_matches_registered_parts(spark):
    from conftest import SMOKE
    import __spark_entry__ as E
    from recordsync.operators.cascade import client_cascade
    from recordsync.plans import queries_more as QM
    t = DomainTables(spark, SMOKE)
    cv = V.client_base(t).join(V.min_industry(t), V.KEYS, "left")
    out = client_cascade(QM.staged_leads(t), cv, t.branches, t.cities, t.states, t.credit_limit_history,
                         t.industries)
    assert {"branch_updates", "credit_limit_history", "client_industries", "new_branches", "new_clients",
            "new_sales_rep_branches", "new_billing_addresses", "new_credit_limit_history"} <= set(out)
    same = lambda a, b: sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert same(out["branch_updates"], E.queries()["branch_update"](spark, SMOKE))
    assert same(out["new_branches"], E.queries()["new_clients"](spark, SMOKE))
    linked = client_cascade(QM.staged_leads(t), cv, t.branches, t.cities, t.states, t.credit_limit_history,
                            initial_load=True)["branches"]
    assert linked.count() == t.branches.count()


def test_full_reload_contacts_of_accepted_leads(spark):
    from conftest import SMOKE
    from pyspark.sql import functions as F
    from recordsync.operators.quality import full_reload
    t = DomainTables(spark, SMOKE)
    e = t.crm_export
    out = full_reload(e, t.crm_contacts, ["id", "lead"])
    acc = {r.id for r in out["leads"].collect()}
    assert all(r.leadId in acc for r in out["contacts"].collect())
    assert out["contacts"].where(F.col("email").isNull()).count() == 0


def test_from_frames_uses_given_tables(spark):
    from conftest import SMOKE
    import pytest
    base = DomainTables(spark, SMOKE)
    t = DomainTables.from_frames(spark, leads=base.leads.limit(5), branches=base.branches, clients=base.clients,
                                 cities=base.cities, countries=base.countries, states=base.states,
                                 credit_limit_history=base.credit_limit_history)
    assert t.leads.count() == 5
    assert V.lead_diff(t).count() <= V.lead_diff(base).count()
    with pytest.raises(ValueError):
        DomainTables.from_frames(spark, nonsense=base.leads)
