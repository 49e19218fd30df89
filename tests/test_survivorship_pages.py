"""Which source a field comes from; landed pages with gaps, missing ends and moved rows; repeated change keys."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from recordsync.operators import merge as M
from recordsync.operators.cascade import new_clients, rejected_leads
from recordsync.operators.survivorship import candidates, set_address, survivors
from recordsync.sources.readers import explode_listings, listing_report


def test_survivors(spark):
    docs = spark.createDataFrame([(1, "2020-01-01", "old", True), (1, "2020-01-02", "new", True), (1, "2020-01-03", "absent", False),
                                  (2, "2020-01-01", None, True)], "id long, at string, city string, has boolean")
    export = spark.createDataFrame([(1, "X", None), (2, "Y", "S"), (3, None, None)], "id long, city string, state string")
    every = candidates(docs, "id", "document", {"city": F.col("city")}, F.col("at").cast("timestamp"), {"city": F.col("has")}).unionByName(
        candidates(export, "id", "export", {"city": F.col("city"), "state": F.col("state")})).unionByName(
        candidates(export, "id", "default", {"state": F.lit("XX")}))
    got = {(r.key, r.field): (r.value, r.source) for r in survivors(every, ["document", "export", "default"]).collect()}
    assert got == {(1, "city"): ("new", "document"), (1, "state"): ("XX", "default"), (2, "city"): (None, "document"),
                   (2, "state"): ("S", "export"), (3, "state"): ("XX", "default")}
    assert survivors(every, ["default"]).count() == 3  # other sources have no say


def test_set_address(spark):
    leads = spark.createDataFrame([(i, "a", 1, "b", "kept") for i in range(1, 5)],
                                  "id long, address_street string, address_number int, address_district string, name string")
    export = spark.createDataFrame([(1, "Rua 1", "12", "C"), (2, None, "SN", None), (4, "Rua 4", "4", "D")],
                                   "id long, street string, number string, district string")
    touched = spark.createDataFrame([(1,), (1,), (2,), (3,)], "id long")
    got = sorted(map(tuple, set_address(leads, touched, export).collect()))
    assert got == [(1, "Rua 1", 12, "C", "kept"), (2, None, 0, None, "kept"), (3, "a", 1, "b", "kept"), (4, "a", 1, "b", "kept")]


def test_landed_pages(spark):
    item = "listing string, page long, value array<struct<id:long,lead:string>>"
    rows = [("whole", 0, [(1, "a"), (2, "b")]), ("whole", 1, [(2, "b moved"), (3, "c")]), ("whole", 2, []),
            ("open", 0, [(4, "d")]), ("open", 1, [(5, "e")]), ("holed", 0, [(6, "f")]), ("holed", 2, [(7, "g")]), ("holed", 3, []),
            ("late", 1, [(8, "h")]), ("late", 2, []), ("empty", 0, []), ("again", 0, [(9, "i")]), ("again", 0, [(9, "i")]), ("again", 1, []),
            ("past", 0, []), ("past", 1, [(10, "j")])]
    pages = spark.createDataFrame(rows, item)
    report = {r.listing: (r.pages, r["items"], r.missing, r.ended, r.status) for r in listing_report(pages).collect()}
    assert report == {"whole": (3, 4, 0, True, "complete"), "open": (2, 2, 0, False, "unfinished"), "holed": (3, 2, 1, True, "holed"),
                      "late": (2, 1, 1, True, "holed"), "empty": (1, 0, 0, True, "complete"), "again": (2, 1, 0, True, "complete"),
                      "past": (2, 1, 0, False, "unfinished")}
    got = sorted((r.listing, r.page, r["item"].id, r["item"].lead) for r in explode_listings(pages).collect())
    assert got == [("again", 0, 9, "i"), ("whole", 0, 1, "a"), ("whole", 1, 2, "b moved"), ("whole", 1, 3, "c")]


def test_merge_snapshot_refuses_repeated_keys(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    once = spark.createDataFrame([(1, "x"), (3, None)], "k long, v string")
    assert sorted(map(tuple, M.merge_snapshot(target, once, ["k"]).collect()), key=repr) == [(1, "x"), (2, "b"), (3, None)]
    with pytest.raises(PySparkException, match="several changes"):
        M.merge_snapshot(target, once.unionByName(once), ["k"]).collect()


def test_long_tax_ids_are_kept_aside(spark):
    """Six leads in: three clients, three rejects; none is marked for deletion for its tax id's length."""
    ids = ["1", "2", "00000000000003", "9" * 15, "8" * 16, "7" * 16]
    columns = ("name address_street address_district address_zipcode address_complement city state phone tax_registration "
               "financial_analysis industry").split()
    leads = spark.createDataFrame([(i, t) for i, t in enumerate(ids)], "id long, taxid string").select(
        "*", F.lit(1).alias("address_number"), F.lit(1).cast("long").alias("sales_rep"), *[F.lit("x").alias(c) for c in columns])
    branches = spark.createDataFrame([(40, "777")], "client long, taxid string")
    cities = spark.createDataFrame([], "id long, city_code long, city_name string, state_code long, country_code string")
    states = spark.createDataFrame([], "code long, name string")
    new = new_clients(leads, branches, cities, states)["branches"]
    assert sorted((r.client, r.taxid) for r in new.collect()) == [(41, "00000000000001"), (42, "00000000000002"), (43, "00000000000003")]
    assert sorted((r.id, r.reason) for r in rejected_leads(leads).collect()) == [(i, "taxid_too_long") for i in (3, 4, 5)]
    crm = leads.select("id", F.col("taxid").alias("cnpj"), F.lit("A").alias("stage"))
    gone = M.stage_regression(leads.withColumn("stage", F.lit("A")), crm, ["A", "B"], {})
    assert sorted((r.id, r.reason) for r in gone.collect()) == [(i, "taxid_too_long") for i in (3, 4, 5)]
