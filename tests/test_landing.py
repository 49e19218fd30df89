"""Landing tables in a queue: more files as they grow, and goes in order."""

from pyspark.sql import functions as F

from recordsync.operators.survivorship import dealt_evenly
from recordsync.plans import catalog
from recordsync.sources.standins import DomainTables
from recordsync.streaming import ingest as I

from conftest import SMOKE


def _queue(spark, path):
    return spark.read.schema("id bigint, name string").json(path).select("id", F.input_file_name().alias("file")).collect()


def test_goes_follow_one_another_in_many_files(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id"), F.concat(F.lit("n"), "id").alias("name"))
    queue, seen = f"{tmp_path}/queue", set()
    for go in I.land_in_order(rows, queue, 2, "id", file_rows=100):
        found = _queue(spark, queue)
        new = {r.id for r in found} - seen
        assert len(found) == len(seen) + len(new) and (not seen or min(new) > max(seen))
        seen |= new
        assert len({r.file for r in found}) >= 4 * (go + 1)  # one task and one file took all of a go
    assert seen == set(range(1000))


def test_few_distinct_keys_and_no_rows(spark, tmp_path):
    rows = spark.range(40).select((F.col("id") % 2).alias("id"), F.lit("x").alias("name"))
    assert [*I.land_in_order(rows, f"{tmp_path}/few", 3, "id", file_rows=5)] == [0, 1, 2]
    assert len(_queue(spark, f"{tmp_path}/few")) == 40
    assert [*I.land_in_order(rows.where("id > 9"), f"{tmp_path}/none", 3, "id")] == [0, 1, 2]
    assert _queue(spark, f"{tmp_path}/none") == []


def test_files_grow_with_the_rows(spark):
    assert [I.files_for(spark.range(n), 4, 10) for n in (0, 1, 40, 41, 400)] == [4, 4, 4, 8, 40]


def test_goes_are_micro_batches(spark, tmp_path):
    rows = spark.range(30).select(F.col("id"), F.lit("x").alias("name"))
    met = []
    I.sync_in_order(rows, f"{tmp_path}/queue", 3, ["id"], f"{tmp_path}/ckpt", lambda b, e: met.append((e, [r.id for r in b.collect()])))
    assert [e for e, _ in met] == [0, 1, 2]
    assert [x for _, ids in met for x in sorted(ids)] == list(range(30))


def test_survivor_documents_are_dealt_evenly(spark, capsys):
    catalog.queries()
    catalog._REGISTRY["lead_survivors"](DomainTables(spark, SMOKE)).explain()
    plan = capsys.readouterr().out
    assert "hashpartitioning(lead_id" in plan and plan.count("REPARTITION_BY_NUM") >= 2  # documents and export
    rows = spark.range(1000).select((F.col("id") % 2).alias("lead"), "id")
    sizes = [r["count"] for r in dealt_evenly(rows, 1000, "lead", "id", task_rows=100).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1000 and len(sizes) == 10 and max(sizes) < 200  # one lead has half of the rows
