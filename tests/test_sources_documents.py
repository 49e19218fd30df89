import json

from pyspark.sql import functions as F

from recordsync.operators import documents as D
from recordsync.schemas import WEBHOOK_LEAD
from recordsync.sources import readers as R
from pyspark.sql import types as T


def test_read_documents_keeps_corrupt_and_lineage(spark, tmp_path):
    (tmp_path / "update_a_converted.json").write_text(json.dumps({"Lead": {"Id": 7, "Company": "A"}}))
    (tmp_path / "update_b_converted.json").write_text("{not json")
    (tmp_path / "other.json").write_text(json.dumps({"Lead": {"Id": 8}}))
    schema = T.StructType([T.StructField("Lead", WEBHOOK_LEAD)])
    docs = R.read_documents(spark, str(tmp_path), schema, glob="*converted.json")
    ok, bad = D.corrupt_split(docs)
    assert [r["Lead"]["Id"] for r in ok.collect()] == [7]
    assert len(bad.collect()) == 1  # all columns: Spark refuses a corrupt-column-only query
    ids = spark.createDataFrame([(7,), (8,)], "id bigint")
    assert D.docs_for_leads(ok, ids).count() == 1


def test_pages_explode_and_completeness(spark):
    pages = spark.createDataFrame([(0, [1, 2]), (1, [3]), (2, [])], "page int, value array<int>")
    assert sorted(r.item for r in R.explode_pages(pages).collect()) == [1, 2, 3]
    c = R.page_completeness(pages).first()
    assert (c.pages, c.items, c.complete) == (3, 3, True)


def test_jdbc_options_require_all(spark):
    import pytest
    with pytest.raises(ValueError):
        R.jdbc_options({"url": "jdbc:x", "user": "u"})
    assert R.jdbc_options({"url": "u", "user": "a", "password": "b", "driver": "d"})["driver"] == "d"


def test_outcome_and_batch_name(spark):
    df = spark.createDataFrame([(201, ""), (400, "Duplicated Keys: _cod.cliente"), (400, "boom")],
                               "status int, msg string")
    got = [r[0] for r in df.select(D.classify_outcome(F.col("status"), F.col("msg"))).collect()]
    assert got == ["ok", "ok_duplicate_client_code", "error"]
    names = df.select(D.batch_name("update_leads", F.lit("ACME S.A./X"), F.col("status")).alias("n")).collect()
    assert names[0].n.startswith("update_leads_ACME_SAX_") and names[0].n.endswith("_201")


def test_json_queue_roundtrip_keeps_nulls(spark, tmp_path):
    from recordsync.sources.sinks import write_queue
    df = spark.createDataFrame([(1, None), (2, "x")], "ID bigint, NAME string").repartition(2)
    path = write_queue(df, str(tmp_path / "q"))
    text = "".join(p.read_text() for p in (tmp_path / "q").glob("part-*"))
    assert '"NAME":null' in text
    back = R.read_json_lines(spark, path, df.schema)
    assert back.columns == ["id", "name"] and back.count() == 2
