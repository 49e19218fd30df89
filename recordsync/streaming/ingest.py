"""Structured Streaming ingestion of the CRM webhook queue.

The source polled queue directories on a schedule, handled files one by one
and moved them to a "processed" folder.  Here a file-source stream reads the
queue with an explicit schema, ``maxFilesPerTrigger`` bounds each
micro-batch, the checkpoint gives exactly-once progress, ``cleanSource``
archives consumed files, and ``foreachBatch`` applies each micro-batch with
the same idempotent batch operators (so a replayed batch after an executor
loss writes the same result again).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import partial_update
from ..sources.webhook import LEAD_CUSTOM, LEAD_KEYS, is_synced, lead_update_fields
from .levels import Levels, bucket_of

CONTACT = T.StructType([
    T.StructField("Id", T.LongType()), T.StructField("LeadId", T.LongType()), T.StructField("Name", T.StringType()),
    T.StructField("Email", T.StringType()), T.StructField("Phone", T.StringType()),
    T.StructField("Position", T.StringType()),
])

DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("received_at", T.TimestampType()),
    T.StructField("kind", T.StringType()),
    T.StructField("lead_id", T.LongType()),
    T.StructField("stage", T.StringType()),
    T.StructField("raw", T.StringType()),
    T.StructField("contacts", T.ArrayType(CONTACT)),
])


#: Rows of a landed file at most (about); larger tables land as more files, so that no task sorts and writes more.
FILE_ROWS = 200_000


def files_for(rows: DataFrame, batches: int = 4, file_rows: int = FILE_ROWS) -> int:
    """How many files ``rows`` land as: the same number for each of ``batches`` micro-batches, none beyond ``file_rows``."""
    return batches * max(1, -(-rows.count() // (batches * file_rows)))


def land_documents(docs: DataFrame, queue_dir: str, files: int = 4) -> str:
    """Write documents as JSON-lines files in time order (test/bench helper:
    one file per range of ``received_at``, like a queue filled over time)."""
    docs.select(*[f.name for f in DOC_SCHEMA.fields]).repartitionByRange(files, "received_at", "doc_id") \
        .sortWithinPartitions("received_at", "doc_id").write.mode("errorifexists").json(queue_dir)
    return queue_dir


def land_in_order(rows: DataFrame, queue_dir: str, batches: int, *order: str, file_rows: int = FILE_ROWS) -> Iterator[int]:
    """Land rows as JSON-lines files in ``batches`` goes, each with the next range of ``order``; whoever asks for the next
    number has dealt with the files of the last.

    All goes are written by one job, in parallel, beside the queue, and moved into it go by go: a stream that is run after
    each takes the goes in their order, whatever number of files they have and however fine the store's times are."""
    spark, waiting = rows.sparkSession, f"{queue_dir.rstrip('/')}-waiting"
    files = files_for(rows, batches, file_rows)
    go = F.floor(F.spark_partition_id() * batches / files)
    ranged = rows.repartitionByRange(files, *order).withColumn("__go", go).sortWithinPartitions("__go", *order)
    ranged.write.mode("errorifexists").partitionBy("__go").json(waiting)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    queue = jvm.org.apache.hadoop.fs.Path(queue_dir)
    fs = queue.getFileSystem(conf)
    fs.mkdirs(queue)
    for n in range(batches):
        folder = jvm.org.apache.hadoop.fs.Path(f"{waiting}/__go={n}")
        for file in fs.listStatus(folder) if fs.exists(folder) else []:
            if not fs.rename(file.getPath(), queue):
                raise OSError(f"{file.getPath()} could not be moved to {queue_dir}")
        yield n


def sync_in_order(rows: DataFrame, queue_dir: str, batches: int, order: list[str], checkpoint: str,
                  apply_fn: Callable[[DataFrame, int], None]) -> None:
    """Land rows go by go (see ``land_in_order``) and apply each as a micro-batch of its own."""
    for _ in land_in_order(rows, queue_dir, batches, *order):
        start_sync(read_queue(rows.sparkSession, queue_dir, schema=rows.schema), checkpoint, apply_fn).awaitTermination()


def read_queue(spark: SparkSession, queue_dir: str, glob: str = "*.json", max_files: int | None = None,
               archive_dir: str | None = None, schema: T.StructType = DOC_SCHEMA,
               delete_consumed: bool = False) -> DataFrame:
    """Streaming scan of a queue directory.

    ``glob`` selects a document kind by file name, ``max_files`` bounds a
    micro-batch, ``archive_dir`` moves consumed files there and
    ``delete_consumed`` removes them instead (``cleanSource``).
    """
    r = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    elif delete_consumed:
        r = r.option("cleanSource", "delete")
    return r.json(queue_dir)


def start_sync(stream: DataFrame, checkpoint: str, apply_fn: Callable[[DataFrame, int], None],
               available_now: bool = True, interval: str | None = None):
    """Run ``apply_fn`` per micro-batch; one query per checkpoint
    (a second start on the same checkpoint fails, so runs never overlap)."""
    w = stream.writeStream.foreachBatch(apply_fn).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval or "3 minutes")
    return w.start()


def append_sink(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink writing each micro-batch to its own epoch folder
    (a replayed epoch overwrites only its own folder: idempotent)."""
    def fn(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/epoch={epoch}")
    return fn


LEAD_FIELDS = list(LEAD_KEYS) + list(LEAD_CUSTOM)
ORDER_TYPE = "struct<received_at:timestamp,doc_id:bigint>"


def doc_fields(raw_col: str = "raw") -> dict:
    return lead_update_fields(F.col(raw_col))


_CHANGE = f"field string, value string, ord {ORDER_TYPE}, bucket int"


class ChangeLogMerge:
    """R6 at scale: a per-field change log in levels instead of rewriting the snapshot every micro-batch.

    Each micro-batch writes, for every (key, field) it touches, the latest value and its order (received_at, doc_id), in
    folders by key bucket: work and output proportional to the batch, whatever the table's size.  Segments are merged
    bucket by bucket (newest order per key and field), so epochs may arrive in any order and a replayed epoch changes
    nothing.  ``snapshot`` applies the log to a base version with one grouped aggregate; asked for some keys, it reads
    the log of their buckets only.  ``compact`` writes that result, with the order of its values, as the next base.
    """

    def __init__(self, root: str, key: str = "id", buckets: int = 32, fan: int = 4, key_type: str = "bigint"):
        self.root, self.key, self.key_type, self.buckets = root.rstrip("/"), key, key_type, buckets
        self.log = Levels(f"{self.root}/log", f"{key} {key_type}, {_CHANGE}", self._latest, fan)

    def _latest(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("bucket", self.key, "field").agg(F.max_by("value", "ord").alias("value"), F.max("ord").alias("ord"))

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        k = self.key
        fields = doc_fields()
        entries = F.array(*[F.struct(F.lit(c).alias("field"), v.cast("string").alias("value"), p.alias("present"))
                            for c, (v, p) in fields.items()])
        rows = (batch.where(is_synced(F.col("raw")))
                .select(F.col("lead_id").alias(k), F.struct("received_at", "doc_id").alias("ord"),
                        F.explode(entries).alias("e"))
                .where(F.col("e.present"))
                .select(k, "ord", F.col("e.field").alias("field"), F.col("e.value").alias("value"),
                        bucket_of(F.col(k), self.buckets).alias("bucket")))
        self.log.add(epoch, self._latest(rows))

    def changes(self, spark: SparkSession, keys: list | None = None) -> DataFrame | None:
        """The latest (key, field, value, ord) of the log, of some keys only where they are given."""
        buckets = None
        if keys is not None:
            asked = spark.createDataFrame([(x,) for x in keys], f"{self.key} {self.key_type}")
            buckets = [r.b for r in asked.select(bucket_of(F.col(self.key), self.buckets).alias("b")).distinct().collect()]
        rows = self.log.rows(spark, buckets)
        if rows is None:
            return None
        rows = rows if keys is None else rows.where(F.col(self.key).isin(keys))
        return self._latest(rows)

    def snapshot(self, spark: SparkSession, base: DataFrame, keep_order: bool = False, keys: list | None = None) -> DataFrame:
        """``base`` with the log applied.  A base made by ``compact`` has the
        order of each value (``_o_<field>``); only newer entries replace it."""
        k = self.key
        base = base if keys is None else base.where(F.col(k).isin(keys))
        columns = [c for c in base.columns if not c.startswith("_o_")]
        order_of = {c: F.col(f"_o_{c}") if f"_o_{c}" in base.columns else F.lit(None).cast(ORDER_TYPE) for c in LEAD_FIELDS}
        latest = self.changes(spark, keys)
        if latest is None:  # no micro-batch written yet: nothing to apply
            return base.select(*columns, *([order_of[c].alias(f"_o_{c}") for c in LEAD_FIELDS] if keep_order else []))
        wide = latest.groupBy(k).agg(*[x for c in LEAD_FIELDS for x in (
            F.max(F.when(F.col("field") == c, F.col("value"))).alias(f"_v_{c}"),
            F.max(F.when(F.col("field") == c, F.col("ord"))).alias(f"_n_{c}"))])
        j = base.join(wide, k, "left")

        def newer(c: str) -> Column:
            return F.col(f"_n_{c}").isNotNull() & (order_of[c].isNull() | (F.col(f"_n_{c}") > order_of[c]))
        out = [F.when(newer(c), F.col(f"_v_{c}").try_cast(base.schema[c].dataType)).otherwise(F.col(c)).alias(c)
               if c in LEAD_FIELDS else F.col(c) for c in columns]
        if keep_order:
            out += [F.when(newer(c), F.col(f"_n_{c}")).otherwise(order_of[c]).alias(f"_o_{c}") for c in LEAD_FIELDS]
        return j.select(*out)

    def compact(self, spark: SparkSession, base: DataFrame, version: str) -> str:
        """Write the applied snapshot, with the order of its values, as a new
        base version; what the log still holds is not newer, so it changes nothing there."""
        path = f"{self.root}/base/v={version}"
        self.snapshot(spark, base, keep_order=True).write.mode("overwrite").parquet(path)
        return path


class LeadChangeChain:
    """R6 (L2 flow): per micro-batch, apply the lead changes (change log) and
    fan the contacts of accepted leads out to the next step, one record per
    contact (N5 + J21), written as ``contacts/epoch=N``.

    ``accepted`` is the set of lead ids known to the ERP (a semi join, so a
    lead with many documents never multiplies rows).
    """

    def __init__(self, root: str, accepted: DataFrame, key: str = "id"):
        self.root = root.rstrip("/")
        self.leads = ChangeLogMerge(f"{self.root}/leads", key)
        self.accepted = accepted.select(F.col(key).alias("_acc"))

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        self.leads(batch, epoch)
        docs = batch.where(is_synced(F.col("raw"))).join(self.accepted, F.col("lead_id") == F.col("_acc"), "left_semi")
        taxid = F.get_json_object("raw", "$.Lead.CpfCnpj").alias("lead_taxid")
        out = docs.select("doc_id", "lead_id", taxid, F.explode("contacts").alias("c")).select(
            "doc_id", "lead_id", "lead_taxid", F.col("c.Id").alias("contact_id"), F.col("c.Name").alias("contact_name"),
            F.col("c.Email").alias("contact_email"))
        out.write.mode("overwrite").parquet(f"{self.root}/contacts/epoch={epoch}")

