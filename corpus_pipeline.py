"""A training-data pipeline: five stages over ``documents``, each on what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's docs.  All but the last return the columns of ``documents``; the last adds the
slot and shard of each document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordsync.llm import jaccard_join, maglev, raking, toxicity, winnowing
from recordsync.llm.common import discard, intermediate, read, row_key, small, written

#: Near duplicates: sets of five-word shingles with a Jaccard similarity of 0.8 or more.
SHINGLE, RATIO = 5, (80, 100)


def aside(docs: DataFrame, *names: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with its columns of these names (that an operator gives too) under others, and its own columns again."""
    clash = {c: f"__own_{c}" for c in docs.columns if c.lower() in names}
    return docs.withColumnsRenamed(clash), [F.col(f"`{clash.get(c, c)}`").alias(c) for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier (learned from the labels) doesn't predict to be toxic; all of them, if there
    is nothing to learn it from."""
    network, share = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    if network is None:
        return docs
    given, own = aside(docs, "score", "predicted")
    return toxicity.score(given, network, share).where("predicted = 0").select(*own)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest id (the last are those without one); of rows equal
    in id and text, one.  A group is what links connect, row by row: rows of one id with other texts are in other
    groups."""
    repeated = docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL")
    if repeated.isEmpty():  # the id names the row
        with intermediate() as spent:
            part = written(jaccard_join.join(docs, k=SHINGLE, ratio=RATIO))
        discard(spark, spent, part)
        gone = small(part.where("doc_id <> component_id").select("doc_id").distinct(), jaccard_join.BROADCAST_IDS)
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    rows = written(docs.withColumn("__row", F.monotonically_increasing_id()))  # written, so that numbers stay
    with intermediate() as spent:
        part = written(jaccard_join.join(rows, "__row", k=SHINGLE, ratio=RATIO))
    discard(spark, spent, part)
    key = row_key(F.col("doc_id"), F.col("text"))
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    order = F.struct(F.col("doc_id").isNull(), "doc_id", *key, F.to_json(F.struct(*rest)) if rest else F.lit(""), "__row")
    listed = rows.select("__row", *key, order.alias("__order")).join(part, "__row")
    worded = F.col("n_shingles") > 0  # texts without words link with nothing: only equal rows are copies
    groups = [F.when(worded, F.col("component_id")), F.when(~worded, F.col("k1")), F.when(~worded, F.col("k2"))]
    kept = listed.groupBy(*groups).agg(F.min("__order").alias("__least"))
    gone = part.select("__row").join(kept.select(F.col("__least.__row").alias("__row")), "__row", "left_anti")
    return rows.join(small(gone, jaccard_join.BROADCAST_IDS), "__row", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    given, own = aside(docs, "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return winnowing.decontaminate(given, read(spark, sf_dir, "benchmark")).where("NOT contaminated").select(*own)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics come near to their target weights."""
    key = row_key(*[F.col(c) for c in ("doc_id", "source", "lang", "text")])
    described = written(raking.described(docs.select(*key, "doc_id", "source", "lang", "text")).drop("text"))
    drawn = written(raking.mix(described).where("selected").select(
        F.col("k1").alias("__d1"), F.col("k2").alias("__d2")).distinct())
    keyed = docs.select("*", key[0].alias("__k1"), key[1].alias("__k2"))
    return keyed.join(drawn, (F.col("__k1") == F.col("__d1")) & (F.col("__k2") == F.col("__d2")), "left_semi").select(
        *docs.columns)


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its slot and shard."""
    return maglev.place(docs, "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", place_in_shards),
]

#: The classifier can't be put in SQL; a test holds run() against plain Python, given the network's scores, and the SQL
#: of mixing and sharding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
