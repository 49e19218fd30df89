"""Sharding by a permutation-filled lookup table (operator 7, native).

Every shard has its own permutation of the slots of a prime-sized table (an
offset and a stride, both from the md5 of its name).  The shards take turns;
at its turn a shard claims the first slot of its permutation that is still
free.  The result is a table of ``size`` shard numbers in which each shard
owns ``size / shards`` slots, give or take one, and of which few entries
change when a shard is added or removed.

A row's slot is ``md5(key) mod size``; one join with the broadcast table
(``size`` rows, a parameter, whatever the data) places it.  No shuffle.

Defined cases: a null key is placed like the empty string; equal keys go to
the same shard; an empty table gives no rows; columns of the input named like
the two output columns are replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, without

SHARDS = tuple(f"shard-{i:05d}" for i in range(64))
TABLE_SIZE = 65537
#: Largest table that is broadcast: about 16 MB as a hash relation.
MAX_TABLE_SIZE = 1_000_003


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(shards: tuple[str, ...], size: int) -> list[int]:
    """Shard number of every slot.  ``size`` is a prime above the number of shards."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names, one at least")
    if not is_prime(size) or not len(shards) < size <= MAX_TABLE_SIZE:
        raise ValueError(f"table size {size}: need a prime above {len(shards)} and up to {MAX_TABLE_SIZE}")
    walks = []
    for name in shards:
        digest = hashlib.md5(name.encode()).digest()
        offset, stride = (int.from_bytes(part, "big") for part in (digest[:8], digest[8:]))
        walks.append([offset % size, stride % (size - 1) + 1])
    table = [-1] * size
    free = size
    while free:
        for shard, walk in enumerate(walks):
            slot, stride = walk
            while table[slot] >= 0:
                slot = (slot + stride) % size
            table[slot] = shard
            walk[0] = (slot + stride) % size
            free -= 1
            if not free:
                break
    return table


def table_frame(spark: SparkSession, table: list[int]) -> DataFrame:
    """(slot, shard) rows of the lookup table, made from one string literal."""
    listed = F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")
    return spark.range(1).select(F.posexplode(listed).alias("slot", "shard"))


def slot_of(key: Column, size: int) -> Column:
    """First 32 bits of the md5 of the key's text, modulo the table's size."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(size)).cast("int")


def place(df: DataFrame, key: str, shards: tuple[str, ...] = SHARDS, size: int = TABLE_SIZE,
          slot_name: str = "slot", shard_name: str = "shard_id") -> DataFrame:
    """``df`` with the slot and shard number of each row."""
    lookup = F.broadcast(table_frame(df.sparkSession, fill_table(shards, size)))
    keyed = df.withColumn("__slot", slot_of(F.col(f"`{key}`"), size))
    placed = keyed.join(lookup.select(F.col("slot").alias("__at"), F.col("shard").alias("__shard")),
                        F.col("__slot") == F.col("__at"))
    kept = without(placed, "__at", "__slot", "__shard", slot_name, shard_name)
    return placed.select(*[placed[f"`{c}`"] for c in kept.columns],
                         placed["__slot"].alias(slot_name), placed["__shard"].alias(shard_name))


def manifest(placed: DataFrame, bytes_name: str = "n_bytes", shard_name: str = "shard_id") -> DataFrame:
    """Rows and bytes of each shard."""
    return placed.groupBy(shard_name).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(bytes_name).alias("n_bytes"))


def write_shards(placed: DataFrame, path: str, files_per_shard: int = 4, shard_name: str = "shard_id",
                 slot_name: str = "slot") -> None:
    """One folder per shard; a shard's slots are spread over ``files_per_shard`` tasks."""
    split = F.pmod(F.col(slot_name), F.lit(files_per_shard))
    placed.repartition(F.col(shard_name), split).write.partitionBy(shard_name).parquet(path)


def op7_maglev_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return place(docs, "doc_id").select("doc_id", "n_bytes", "slot", "shard_id")


def op7_sql() -> str:
    table = fill_table(SHARDS, TABLE_SIZE)
    return f"""
        WITH lookup AS (
            SELECT unnest({table}) AS shard_id, unnest(range({TABLE_SIZE})) AS slot
        ), keyed AS (
            SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
                   ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % {TABLE_SIZE} AS slot
            FROM documents
        )
        SELECT doc_id, n_bytes, slot::INTEGER AS slot, shard_id::INTEGER AS shard_id
        FROM keyed JOIN lookup USING (slot)
    """
