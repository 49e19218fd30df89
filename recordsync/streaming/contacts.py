"""Contact changes per micro-batch (M17): the rows that a micro-batch changes, not the table, are written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.contacts import CONTACT, contacts_changed
from ..operators.quality import assign_ids
from .epochs import EpochTables, IdLedger


class ContactSink:
    """A foreachBatch sink: per epoch the contacts that its changes set (``contacts``) and removed (``gone``).

    Codes of new contacts come in blocks from an ``IdLedger``.  ``current`` is the table before the stream with the last
    epoch's row of each code, without those that are gone.
    """

    def __init__(self, root: str, target: DataFrame, order: str):
        self.tables, self.target, self.order = EpochTables(root), target.select(*CONTACT), order
        start = target.agg(F.coalesce(F.max("code"), F.lit(0)).cast("bigint")).first()[0]
        self.codes = IdLedger(root, "contact", start)

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        if epoch in self.tables.manifests(spark):
            return
        met, after, _ = contacts_changed(self.current(spark, epoch), batch, self.order)
        new = after.where("code IS NULL").drop("code")
        start = self.codes.claim(spark, epoch, new.count())
        rows = after.where("code IS NOT NULL").unionByName(assign_ids(new, start, ["at"], "code"), allowMissingColumns=True)
        gone = met.select("code").join(after.select("code"), "code", "left_anti")
        self.tables.write(spark, epoch, {"contacts": rows.select(*CONTACT), "gone": gone})

    def current(self, spark: SparkSession, epoch: int | None = None) -> DataFrame:
        """The contacts now, or before an epoch."""
        rows = self.tables.read(spark, "contacts", self.target.schema, epoch)
        gone = self.tables.read(spark, "gone", "code bigint", epoch)
        last = rows.select("code", "epoch", F.struct(*CONTACT).alias("row")).unionByName(
            gone.select("code", "epoch", F.lit(None).cast(rows.select(F.struct(*CONTACT).alias("r")).schema["r"].dataType).alias("row")))
        last = last.groupBy("code").agg(F.max_by(F.struct("row"), "epoch").alias("l"))  # around the row: it may be null
        known = self.target.join(last.select("code"), "code", "left_anti").select(*CONTACT)
        return known.unionByName(last.where("l.row IS NOT NULL").select("l.row.*"))
