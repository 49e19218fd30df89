"""Hot keys found by the sketch, and staged tables that hold one."""

import statistics

from pyspark.sql import functions as F

from conftest import SMOKE
from recordsync.operators.skew import hot_keys, split_hot
from recordsync.plans import catalog, queries_more  # noqa: F401  (registers the keys)
from recordsync.sources.standins import DomainTables, stage


def test_hot_keys(spark):
    df = spark.range(30_000).select(F.when(F.col("id") < 10_000, 7).when(F.col("id") < 16_000, None).otherwise(F.col("id")).alias("k"))
    assert sorted(hot_keys(df, "k", 16), key=str) == [7, None]
    assert hot_keys(df, "k", 3) == [] and hot_keys(spark.range(1000), "id", 64) == [] and hot_keys(df.where("false"), "k", 8) == []
    hot, rest = split_hot(df, "k", [7, None])
    assert (hot.count(), rest.count()) == (16_000, 14_000) and rest.where("k IS NULL OR k = 7").count() == 0
    assert split_hot(df, "k", [7])[1].where("k IS NULL").count() == 6_000


def rows_per_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_staged_hot_client(spark, tmp_path):
    """A client with a third of the sale lines: results as derived, and no task with more than a few times the median."""
    t = DomainTables(spark, SMOKE)
    lines = t.sale_lines
    busiest = lines.groupBy("lead_id").count().orderBy(F.desc("count"), "lead_id").first().lead_id
    extra = lines.where(F.col("lead_id") != busiest).withColumn("lead_id", F.lit(busiest)).limit(lines.count() // 2)
    t.__dict__["sale_lines"] = spark.createDataFrame(lines.unionByName(extra).collect(), lines.schema)
    keys = ["sold_products", "product_total"]
    before = {k: sorted(map(tuple, catalog._REGISTRY[k](t).collect())) for k in keys}
    assert hot_keys(t.sale_lines, "lead_id", 16) == [busiest]
    for bucketed in (True, False):
        staged = stage(t, str(tmp_path / f"staged-{bucketed}"), partitions=16, bucketed=bucketed)
        assert staged.sale_lines.count() == t.sale_lines.count()
        assert {k: sorted(map(tuple, catalog._REGISTRY[k](staged).collect())) for k in keys} == before
        per_task = rows_per_task(staged.sale_lines)
        assert max(per_task) <= 4 * statistics.median(per_task)
