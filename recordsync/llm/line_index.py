"""Line dedup through a sharded minimal perfect hash (operator 6).

Spark groups the keys of all lines (128-bit hashes) to the number of documents
that hold each and the largest of their ids.  The distinct hashes are dealt to
shards of about ``SHARD_KEYS``; each shard gets a minimal perfect hash, which
maps its n keys to 0..n-1, and three arrays in that order: fingerprint, count
and keeper.  Documents send the hashes of their lines, not the lines, to the
shard, read its arrays and get back the positions of the lines to drop.  A
shard asked more than ``PROBES`` times is copied, and its probes are dealt over
the copies, so a line that every document holds overloads no task.

A document is a doc_id (null is one of its own, the smallest); repeated rows
of one doc_id count once and, with equal text, get equal results.  Null or
empty texts have one empty line.  A table without lines of ``min_length`` code
points loses nothing.  An empty table gives no rows, a very long text is split
whole, and columns with the names of new ones are replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, read, row_key, written

MIN_LENGTH = 40
MIN_DOCS = 5
SHARD_KEYS = 100_000
PROBES = 500_000
#: Space of a level of the hash in slots per key, and the most levels; keys left after them are listed.
GAMMA = 2.0
LEVELS = 24
#: Shards whose loads are broadcast (24 bytes each); beyond, Spark shuffles for that join.
BROADCAST_SHARDS = 100_000
NO_ID = -(1 << 63)
BLANKS = " \t\n\x0b\x0c\r"


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: levels of bits, in which a key sits at the
    first level where its slot is its own; its number is the count of set bits before it."""

    def __init__(self, sizes: list[int], bits: np.ndarray, listed: np.ndarray):
        self.sizes, self.bits, self.listed = sizes, bits, listed  # listed: sorted keys without a slot
        self.before = np.concatenate([[0], np.cumsum(bits)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, sizes, levels = keys.astype(np.uint64), [], []
        while len(left) and len(sizes) < LEVELS:
            size = max(64, int(GAMMA * len(left)))
            slot = (_mixed(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(slot, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[slot]]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool), np.sort(left))

    def number(self, keys: np.ndarray) -> np.ndarray:
        """0..n-1 for keys of the build; for others any number or -1."""
        keys = keys.astype(np.uint64)
        found, left, start = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            slot = start + (_mixed(keys[left], level) % np.uint64(size)).astype(np.int64)
            own = self.bits[slot]
            found[left[own]] = self.before[slot[own]]
            left, start = left[~own], start + size
        if len(left) and len(self.listed):
            at = np.minimum(np.searchsorted(self.listed, keys[left]), len(self.listed) - 1)
            own = self.listed[at] == keys[left]
            found[left[own]] = self.before[-1] + at[own]
        return found

    def to_bytes(self) -> bytes:
        head = np.array([len(self.sizes), len(self.listed), *self.sizes], np.int64)
        return head.tobytes() + self.listed.tobytes() + np.packbits(self.bits).tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> PerfectHash:
        n, m = np.frombuffer(raw, np.int64, 2)
        sizes = np.frombuffer(raw, np.int64, n, 16).tolist()
        listed = np.frombuffer(raw, np.uint64, m, 16 + 8 * n)
        packed = np.frombuffer(raw, np.uint8, offset=16 + 8 * (n + m))
        return cls(sizes, np.unpackbits(packed, count=sum(sizes)).astype(bool), listed)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keyed_lines(docs: DataFrame, min_length: int) -> DataFrame:
    """(id, k1, k2, pos, h1, h2): the lines that are long enough; docs: id, text."""
    key = row_key(F.col("id"), F.col("text"))
    lines = docs.select("id", *key, F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    keys = lines.select("id", "k1", "k2", "pos", line_key(F.col("line")).alias("key"))
    keys = keys.where(F.char_length("key") >= min_length)
    return keys.select("id", "k1", "k2", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))


SHARD_SCHEMA = "shard long, load long, hash binary, fingerprints binary, counts binary, keepers binary"


def _build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    # Of two keys with one h1 (chance about n * n / 2**64) one has a slot; the fingerprint keeps the other's lines.
    rows = rows.drop_duplicates("h1")
    h1, h2 = rows.h1.to_numpy().view(np.uint64), rows.h2.to_numpy().view(np.uint64)
    perfect = PerfectHash.build(h1)
    order = np.argsort(perfect.number(h1))
    made = {"shard": rows.shard.iloc[0], "load": rows.n_lines.sum(), "hash": perfect.to_bytes(),
            "fingerprints": h2[order].tobytes(), "counts": rows.n_docs.to_numpy()[order].tobytes(),
            "keepers": rows.keeper.to_numpy()[order].tobytes()}
    return pd.DataFrame([made])


def _probe(min_docs: int):
    def probe(key: tuple, probes: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        if not len(probes):
            return pd.DataFrame({"k1": [], "k2": [], "pos": []})
        arrays = index.iloc[0]
        h1, h2 = probes.h1.to_numpy().view(np.uint64), probes.h2.to_numpy().view(np.uint64)
        at = PerfectHash.from_bytes(arrays["hash"]).number(h1)
        member = (at >= 0) & (np.frombuffer(arrays.fingerprints, np.uint64)[at] == h2)
        drop = member & (np.frombuffer(arrays.counts, np.int64)[at] >= min_docs)
        drop &= np.frombuffer(arrays.keepers, np.int64)[at] != probes.id.to_numpy()
        return probes.loc[drop, ["k1", "k2", "pos"]]
    return probe


def dropped_lines(docs: DataFrame, min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS) -> DataFrame:
    """(k1, k2, pos) of the lines to drop; docs: id (long, not null), text."""
    spark = docs.sparkSession
    lines = keyed_lines(docs, min_length)
    per_doc = lines.groupBy("h1", "h2", "id").agg(F.count(F.lit(1)).alias("n"))
    counted = written(per_doc.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_lines"), F.max("id").alias("keeper")))
    shards = max(1, math.ceil(counted.count() / SHARD_KEYS))
    shard = F.pmod(F.col("h1"), F.lit(shards)).alias("shard")
    index = written(counted.select("*", shard).groupBy("shard").applyInPandas(_build_shard, SHARD_SCHEMA))
    copies = index.select("shard", F.ceil(F.col("load") / PROBES).cast("int").alias("copies"))
    copies = F.broadcast(copies) if shards <= BROADCAST_SHARDS else copies
    probes = lines.select("id", "k1", "k2", "pos", "h1", "h2", shard).join(copies, "shard").withColumn(
        "copy", F.pmod(F.xxhash64("k1", "pos"), F.col("copies")).cast("int")).drop("copies")
    copied = index.withColumn("copy", F.explode(F.sequence(F.lit(0), F.ceil(F.col("load") / PROBES).cast("int") - 1)))
    return probes.groupBy("shard", "copy").cogroup(copied.groupBy("shard", "copy")).applyInPandas(
        _probe(min_docs), "k1 long, k2 long, pos int")


def dedup_lines(docs: DataFrame, id_name: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
                min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` (all rows and columns) with n_lines, n_dropped and kept_text."""
    made = ["n_lines", "n_dropped", "kept_text"]
    named = docs.select(F.coalesce(F.col(f"`{id_name}`").cast("long"), F.lit(NO_ID)).alias("id"),
                        F.col(f"`{text}`").alias("text"))
    drops = dropped_lines(named, min_length, min_docs).groupBy(
        F.col("k1").alias("__d1"), F.col("k2").alias("__d2")).agg(F.collect_set("pos").alias("__drops"))
    kept = [f"`{c}`" for c in docs.columns if c.lower() not in made]
    k1, k2 = row_key(F.coalesce(F.col(f"`{id_name}`").cast("long"), F.lit(NO_ID)), F.col(f"`{text}`"))
    joined = docs.select(*kept, k1.alias("__k1"), k2.alias("__k2")).join(
        drops, (F.col("__k1") == F.col("__d1")) & (F.col("__k2") == F.col("__d2")), "left")
    cut = joined.select(*kept, "__drops", _lines(F.col(f"`{text}`")).alias("__lines"))
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__drops"))
    kept_lines = F.when(F.col("__drops").isNull(), F.col("__lines")).otherwise(
        F.transform(left, lambda i: F.get("__lines", i)))
    return cut.select(*kept, F.size("__lines").cast("long").alias("n_lines"),
                      F.when(F.col("__drops").isNull(), 0).otherwise(F.size("__drops")).cast("long").alias("n_dropped"),
                      F.array_join(kept_lines, "\n").alias("kept_text"))


def op6_line_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped",
                                    F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP6_SQL = r"""
    WITH numbered AS (
        SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
    ), keyed AS (
        SELECT r, doc_id, pos, lines[pos] AS line,
               translate(trim(lines[pos], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS pos FROM numbered)
    ), repeated AS (
        SELECT key, max(coalesce(doc_id, -9223372036854775808)) AS keeper FROM keyed WHERE length(key) >= 40
        GROUP BY key HAVING count(DISTINCT coalesce(doc_id, -9223372036854775808)) >= 5
    ), judged AS (
        SELECT r, pos, line, keeper IS NOT NULL AND keeper <> coalesce(doc_id, -9223372036854775808) AS dropped
        FROM keyed LEFT JOIN repeated USING (key)
    ), summed AS (
        SELECT r, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '') AS kept
        FROM judged GROUP BY r
    )
    SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM numbered JOIN summed USING (r)
"""
