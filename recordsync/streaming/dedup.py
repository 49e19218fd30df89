"""Documents by content fingerprint, once for good, without state in memory.

The ledger of fingerprints lies in levels (see ``Levels``), in folders by a prefix of the fingerprint.  With every segment
and folder goes a Bloom filter in blocks of 4 kB, each one row: a fingerprint's bits all lie in one block, so a micro-batch
reads the blocks that its fingerprints fall into, and the fingerprints themselves only of folders where a block says that
one may be there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import row_fingerprint
from ..session import cut_lineage
from .levels import Levels, bucket_of

#: Bits of a block, fingerprints that fill one (10 bits each, one in a hundred strangers passes), bits of a fingerprint.
BLOCK_BITS, BLOCK_ROWS, BITS = 32_768, 3_276, 5
_ROW = "fingerprint string, bucket int"
_BLOOM = "block bigint, bits binary, bucket int"


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), "fingerprint"), F.lit(blocks))


def _places() -> Column:
    """Bit numbers of a fingerprint in its block."""
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), "fingerprint"), F.lit(BLOCK_BITS)) for i in range(BITS)])


def _is_set(bits: Column, place: Column) -> Column:
    """Whether the bit that bitmap_bit_position(place) names is set."""
    octet = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(octet, (place % 8).cast("int")) == 1


class LedgerDedup:
    """A foreachBatch sink that writes the documents whose fingerprint no earlier epoch has, to ``documents``.

    A replayed epoch rewrites only its own folder of documents, and its fingerprints count once: the ledger skips an epoch
    it holds, and a document is new to an epoch if no *other* epoch has it.
    """

    def __init__(self, root: str, fingerprint_of: list[str], keep: list[str], buckets: int = 64, fan: int = 4):
        self.root, self.fingerprint_of, self.keep, self.buckets = root.rstrip("/"), fingerprint_of, keep, buckets
        self.ledger = Levels(f"{self.root}/ledger", _ROW, lambda rows: rows.select("fingerprint", "bucket").distinct(), fan, self._bloom)

    def _blocks(self, rows: int) -> int:
        """Blocks of a segment's filter in each folder; fingerprints are spread evenly over the folders."""
        return max(1, -(-rows // (self.buckets * BLOCK_ROWS)))

    def _bloom(self, spark: SparkSession, name: str, path: str, rows: int) -> None:
        bits = spark.read.schema(_ROW).parquet(path) if rows else spark.createDataFrame([], _ROW)
        bits = bits.select("bucket", _block(self._blocks(rows)).alias("block"), F.explode(_places()).alias("place"))
        bits.groupBy("bucket", "block").agg(F.bitmap_construct_agg(F.col("place")).alias("bits")).repartition("bucket").sortWithinPartitions(
            "bucket", "block").write.option("parquet.page.size", 4096).partitionBy("bucket").parquet(f"{self.root}/bloom/{name}")

    @property
    def documents(self) -> str:
        return f"{self.root}/documents"

    def known(self, spark: SparkSession, asked: DataFrame) -> DataFrame:
        """Those of ``asked`` (fingerprint, bucket) that the ledger has."""
        found = asked.where("false").select("fingerprint")
        touched = [r.bucket for r in asked.select("bucket").distinct().collect()]  # as many rows as folders at most
        for s in self.ledger.segments(spark):
            if not s.rows or not touched:
                continue
            bloom = spark.read.schema(_BLOOM).parquet(f"{self.root}/bloom/{s.name}").where(F.col("bucket").isin(touched))
            here = asked.withColumn("block", _block(self._blocks(s.rows)))
            wanted = [r.block for r in here.select("block").distinct().limit(1001).collect()]
            bloom = bloom.where(F.col("block").isin(wanted)) if len(wanted) <= 1000 else bloom  # pages of other blocks are passed over
            maybe = here.join(bloom, ["bucket", "block"]).where(F.forall(_places(), lambda p: _is_set(F.col("bits"), p)))
            maybe = cut_lineage(maybe.select("fingerprint", "bucket"))
            folders = [r.bucket for r in maybe.select("bucket").distinct().collect()]
            if folders:
                rows = spark.read.schema(_ROW).parquet(self.ledger.path(s.name)).where(F.col("bucket").isin(folders))
                found = found.unionByName(maybe.join(rows, ["fingerprint", "bucket"], "left_semi").select("fingerprint"))
        return found

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        if self.ledger.holds(spark, epoch):
            return
        new = batch.withColumn("fingerprint", row_fingerprint(*self.fingerprint_of)).select(*self.keep, "fingerprint")
        new = cut_lineage(new.dropDuplicates(["fingerprint"]).withColumn("bucket", bucket_of(F.col("fingerprint"), self.buckets)))
        fresh = cut_lineage(new.join(self.known(spark, new.select("fingerprint", "bucket")), "fingerprint", "left_anti"))
        fresh.select(*self.keep, "fingerprint").write.mode("overwrite").parquet(f"{self.documents}/epoch={epoch}")
        self.ledger.add(epoch, fresh.select("fingerprint", "bucket"))
