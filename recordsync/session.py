"""SparkSession helpers.

The library never hard-codes a cluster; it reads what the session has.  The
only thing we set ourselves is a checkpoint directory when the session has
none (local tests), because lineage cuts must go to shared storage.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # ANSI is on by default in Spark 4; operators use try_* where the
    # source system fell back on exceptions.
    "spark.sql.ansi.enabled": "true",
    # Joins whose keys extend an existing hash partitioning (e.g. budget
    # number, then item) reuse it instead of shuffling again.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Streaming dedup/merge state can grow with the key space: keep it off-heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "recordsync", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _own_folder(master: str | None) -> str:
    """A folder of this machine, where all tasks run on it; else an error."""
    if not re.match(r"local(\[|$)", master or ""):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share; "
                           "a folder of one machine holds no intermediate data of a cluster")
    return tempfile.mkdtemp(prefix="recordsync-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster checkpoint dir; only when unset (tests) create one."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (e.g. a Spark Connect session has no SparkContext)
        d = spark.conf.get("spark.checkpoint.dir", None)
        return d or _own_folder(spark.conf.get("spark.master", None))
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = _own_folder(sc.master)  # only where no shared folder is named (local tests)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def checkpoint_dir(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark)


def cut_lineage(df, eager: bool = True):
    """Materialise ``df`` in the cluster's checkpoint folder and cut its
    lineage: later actions (several outputs of one frame) read the files,
    and a lost executor does not force recomputing the whole plan.  Never
    a local checkpoint (that would live on the lost executor)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
