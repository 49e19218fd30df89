"""Logs in levels: the dedup ledger and the change log, in any order, replayed, pruned; what a micro-batch reads."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from recordsync.functions.text import row_fingerprint
from recordsync.streaming.dedup import LedgerDedup
from recordsync.streaming.ingest import ChangeLogMerge
from recordsync.streaming.levels import Levels, bucket_of

DOC = "doc_id long, body string"


def docs(spark, bodies):
    return spark.createDataFrame(list(enumerate(bodies)), DOC)


def test_levels_merge_and_prune(spark, tmp_path):
    log = Levels(str(tmp_path), "x long, bucket int", lambda rows: rows.select("x", "bucket").distinct(), fan=3)
    assert log.segments(spark) == [] and log.rows(spark) is None

    def rows(*values):
        return spark.createDataFrame([(v,) for v in values], "x long").withColumn("bucket", bucket_of(F.col("x"), 4))
    for epoch in range(10):
        assert log.add(epoch, rows(epoch, 100))
        assert not log.add(epoch, rows(555))  # a replay
    found = log.segments(spark)
    assert [(s.level, [tuple(e) for e in s.epochs]) for s in found] == [(2, [(0, 8)]), (0, [(9, 9)])]
    assert sorted(r.x for r in log.rows(spark).collect()) == [*range(10), 100, 100]
    before = len(glob.glob(f"{tmp_path}/segments/*"))
    assert log.prune(spark, keep=1) == before - 2 and log.prune(spark) == 0
    assert sorted(r.x for r in log.rows(spark).collect()) == [*range(10), 100, 100]
    some = log.rows(spark, [1])
    assert "PartitionFilters: [" in some._jdf.queryExecution().toString() and {r.bucket for r in some.collect()} <= {1}
    assert log.add(10, rows()) and log.holds(spark, 10)  # an empty epoch


def test_ledger_dedup_is_a_set(spark, tmp_path):
    rnd, seen, sink = random.Random(2), set(), LedgerDedup(str(tmp_path), ["body"], ["doc_id", "body"], buckets=4, fan=3)
    for epoch in range(9):
        bodies = [f"b{rnd.randrange(120)}" for _ in range(40)] if epoch != 5 else []
        sink(docs(spark, bodies), epoch)
        fresh = {r.body for r in spark.read.parquet(sink.documents).where(F.col("epoch") == epoch).collect()}
        assert fresh == set(bodies) - seen
        seen |= set(bodies)
        if epoch == 3:
            sink = LedgerDedup(str(tmp_path), ["body"], ["doc_id", "body"], buckets=4, fan=3)  # a restart
            sink(docs(spark, ["never"]), 3)  # a replayed epoch
    assert sorted(r.body for r in spark.read.parquet(sink.documents).collect()) == sorted(seen)


def test_bloom_has_no_false_negatives_and_few_false_positives(spark, tmp_path):
    sink = LedgerDedup(str(tmp_path), ["body"], ["body"], buckets=2)
    have = spark.range(20_000).select(F.concat(F.lit("a"), "id").alias("body"))
    sink(have, 0)
    segment = sink.ledger.segments(spark)[0]
    assert sink._blocks(segment.rows) == 4

    def print_of(df):
        return df.select(row_fingerprint("body").alias("fingerprint")).withColumn("bucket", bucket_of(F.col("fingerprint"), 2))
    assert sink.known(spark, print_of(have)).count() == 20_000
    other = print_of(spark.range(20_000).select(F.concat(F.lit("z"), "id").alias("body")))
    assert sink.known(spark, other).count() == 0


def test_lookup_reads_no_more_with_the_epochs(spark, tmp_path, monkeypatch):
    """Folders of fingerprints are opened for blooms that hit alone; blooms read stay within the levels' segments."""
    opened = []
    sink = LedgerDedup(str(tmp_path), ["body"], ["body"], buckets=2, fan=3)
    monkeypatch.setattr(sink.ledger, "path", lambda name, plain=sink.ledger.path: opened.append(name) or plain(name))
    for epoch in range(12):
        sink(docs(spark, [f"e{epoch}-{i}" for i in range(30)]), epoch)
        opened.clear()
        asked = docs(spark, [f"new{epoch}-{i}" for i in range(30)]).select(row_fingerprint("body").alias("fingerprint"))
        sink.known(spark, asked.withColumn("bucket", bucket_of(F.col("fingerprint"), 2))).count()
        assert len(opened) <= 1 and len(sink.ledger.segments(spark)) <= 5


WEBHOOK = "doc_id long, received_at timestamp, lead_id long, raw string"


@pytest.mark.parametrize("order", [[0, 1, 2, 3, 4, 5], [5, 3, 0, 4, 1, 2]])
def test_change_log_in_any_order(spark, tmp_path, order):
    rnd = random.Random(4)
    base = spark.createDataFrame([(i, "old", "0", None) for i in range(20)], "id long, name string, phone string, city string")
    rows = [(d, i, f'{{"Lead":{{"Stage":"Ativação","Company":"n{d}"' + (f',"Phone":"{d}"' if d % 2 else "") + (
        ',"Address":{"City":null}' if d % 5 == 0 else "") + "}}") for d, i in enumerate(rnd.choices(range(20), k=60))]
    frame = spark.createDataFrame(rows, "doc_id long, lead_id long, raw string").withColumn(
        "received_at", F.timestamp_seconds(F.col("doc_id"))).select("doc_id", "received_at", "lead_id", "raw")
    want = {i: ["old", "0", None] for i in range(20)}
    for d, i, _ in rows:
        want[i][0] = f"n{d}"
        want[i][1] = str(d) if d % 2 else want[i][1]
    log = ChangeLogMerge(str(tmp_path), buckets=4, fan=3)
    for n, epoch in enumerate(order):
        part = frame.where(F.col("doc_id").between(epoch * 10, epoch * 10 + 9))
        log(part, epoch)
        log(part, epoch)
        if n == 3:
            base = spark.read.parquet(log.compact(spark, base, "1"))
            assert log.log.prune(spark) >= 0
    got = {r.id: [r.name, r.phone, r.city] for r in log.snapshot(spark, base).collect()}
    assert got == want
    some = log.snapshot(spark, base, keys=[3, 4])
    assert {r.id: [r.name, r.phone, r.city] for r in some.collect()} == {i: want[i] for i in (3, 4)}
