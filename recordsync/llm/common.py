"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import gc
import string
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Lower-casing in the contracts touches these letters alone.
UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase


#: Characters of a plan's text that Spark keeps of each write, for as long as it lists its executions.
PLAN_TEXT = "spark.sql.maxPlanStringLength", 2_000


#: Bytes of an Arrow batch between Spark and Python; by default 64 MB, which each task holds several times outside the heap.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


#: What ``jcmd`` knows as System.trim_native_heap (Java 17.0.9 and later, with the GNU C library).
TRIM = "com.sun.management:type=DiagnosticCommand", "systemTrimNativeHeap"


def trim(spark: SparkSession) -> None:
    """Hand back to the system what is free in the driver's JVM outside its heap: the C library keeps it apart for the
    threads that had it, and a job of many joins has hundreds of them."""
    jvm, (bean, command) = spark._jvm, TRIM
    server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
    kind = jvm.java.lang.Class.forName("javax.management.MBeanServer")  # the server's own class can't be called from outside
    invoke = next(m for m in kind.getMethods() if m.getName() == "invoke")
    given = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)
    given[0], given[1] = jvm.javax.management.ObjectName(bean), command
    with contextlib.suppress(Py4JJavaError):  # a JVM that doesn't know the command
        invoke.invoke(server, given)


def release(spark: SparkSession) -> None:
    """Collect the driver's garbage: Spark's cleaner then drops the shuffles and broadcasts of finished steps, which it
    does only for frames that were collected, and a driver with much memory left would keep them for long."""
    gc.collect()
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        jvm.System.gc()
        trim(spark)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


#: Lists that collect the paths of written tables (see intermediate).
_collecting: list[list[str]] = []


@contextlib.contextmanager
def intermediate() -> Iterator[list[str]]:
    """The paths of the tables that are written meanwhile."""
    paths: list[str] = []
    _collecting.append(paths)
    try:
        yield paths
    finally:
        _collecting.remove(paths)


def discard(spark: SparkSession, paths: list[str], *keep: DataFrame) -> None:
    """Delete written tables that nothing reads any more: all that came from them is written itself."""
    kept = {getattr(df, "_written_to", None) for df in keep}
    for path in paths:
        if path not in kept:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    paths[:] = [p for p in paths if p in kept]


def written(df: DataFrame, *partition_by: str, compression: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder of the cluster, read back.

    Cuts the lineage (a lost executor rereads files, it does not recompute)
    and gives later joins a size to plan with.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{uuid.uuid4().hex}"
    schema = df.schema
    release(spark)  # each time: the driver keeps the plans, broadcasts and generated classes of one step, not of several
    w = df.write.mode("error")
    w = w.option("compression", compression) if compression else w
    name, most = PLAN_TEXT
    before = spark.conf.get(name)
    spark.conf.set(name, most)  # plans of joins by the dozen are told again at each of their steps
    try:
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    finally:
        spark.conf.set(name, before)
    for paths in _collecting:
        paths.append(path)
    kept = spark.read.schema(schema).parquet(path)
    kept._written_to = path
    return kept


@contextlib.contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """What is run meanwhile hands rows to Python in batches of about BATCH_BYTES (a longer row is a batch of its own)."""
    name, most = BATCH_BYTES
    before = spark.conf.get(name)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` written out, and broadcast in joins if it has at most ``rows`` rows; else Spark shuffles it."""
    kept = written(df)
    return F.broadcast(kept) if kept.count() <= rows else kept


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less its columns of these names (compared like the session compares names: without case)."""
    mine = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in mine])


def row_key(*cols: Column) -> list[Column]:
    """Two longs that name a row by its values (128 bits; nulls have values of their own)."""
    tagged = [x for c in cols for x in (c.isNull(), c)]
    return [F.xxhash64(F.lit(1), *tagged).alias("k1"), F.xxhash64(F.lit(2), *tagged).alias("k2")]
