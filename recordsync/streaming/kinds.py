"""One typed stream per kind of queue document (R1, Q-5).

The queue holds one JSON document per file and the file's name tells its kind.  Every kind has a schema of its own; a
document that is not of its kind's schema is never lost or half applied: it goes to the dead letters with its file, its
text and the reason.  Kinds without a schema are only archived.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import DOCUMENT_KINDS
from .epochs import EpochTables

_CORRUPT = "_corrupt"
DEAD = "file string, kind string, reason string, body string"


def read_files(spark: SparkSession, path: str, stream: bool = True, max_files: int | None = None,
               archive_dir: str | None = None, glob: str = "*.json") -> DataFrame:
    """(file, body) of a queue folder, one row per file (Spark passes over files of no bytes); consumed files move to
    ``archive_dir``."""
    r = (spark.readStream if stream else spark.read).format("text").option("wholetext", True).option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return r.load(path).select(F.url_decode(name).alias("file"), F.col("value").alias("body"))


def kind_of(file: Column) -> Column:
    """The kind whose prefix the file's name has; NULL if none."""
    return reduce(lambda rest, k: F.when(file.startswith(k[1].prefix), F.lit(k[0])).otherwise(rest),
                  DOCUMENT_KINDS.items(), F.lit(None).cast("string"))


def _unexpected(body: Column, schema: T.StructType, path: str = "$") -> Column:
    """Names (with their path) of the object's keys that the schema lacks, also in objects within."""
    here = body if path == "$" else F.get_json_object(body, path)
    own = F.array_except(F.coalesce(F.json_object_keys(here), F.array().cast("array<string>")),
                         F.array(*[F.lit(f.name) for f in schema]))
    found = [F.transform(own, lambda k: F.concat(F.lit(path[2:] + "." if path != "$" else ""), k))]
    found += [_unexpected(body, f.dataType, f"{path}.{f.name}") for f in schema if isinstance(f.dataType, T.StructType)]
    return F.concat(*found)


def _schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def _checked(docs: DataFrame, kind: str) -> DataFrame:
    """Documents (file, body) of a kind, parsed, with the ``reason`` against them."""
    schema = _schema(DOCUMENT_KINDS[kind].schema)
    whole = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = docs.withColumn("doc", F.from_json("body", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}))
    extra = _unexpected(F.col("body"), schema)
    # Through a lambda: asked for this field alone, the optimizer parses nothing else, and a wrong type goes unseen.
    told = F.get(F.transform(F.array("doc"), lambda d: d[_CORRUPT]), F.lit(0))
    bad = F.col("doc").isNull() | told.isNotNull() | F.json_object_keys("body").isNull()
    return parsed.withColumn("reason", F.when(bad, F.lit("corrupt")).when(
        F.size(extra) > 0, F.concat(F.lit("unexpected: "), F.array_join(F.array_sort(extra), ","))))


def typed(docs: DataFrame, kind: str) -> DataFrame:
    """(file, the kind's fields) of the kind's sound documents among (file, body)."""
    fields = [F.col(f"doc.{f.name}").alias(f.name) for f in _schema(DOCUMENT_KINDS[kind].schema)]
    mine = docs.where(kind_of(F.col("file")) == kind)
    return _checked(mine, kind).where(F.col("reason").isNull()).select("file", *fields)


def dead_letters(docs: DataFrame) -> DataFrame:
    """(file, kind, reason, body) of the documents that are of no kind, or not as their kind's schema says."""
    named = docs.withColumn("kind", kind_of(F.col("file")))
    out = named.where(F.col("kind").isNull()).select("file", "kind", F.lit("unknown kind").alias("reason"), "body")
    for kind, spec in DOCUMENT_KINDS.items():
        if spec.schema:
            bad = _checked(named.where(F.col("kind") == kind), kind).where(F.col("reason").isNotNull())
            out = out.unionByName(bad.select("file", "kind", "reason", "body"))
    return out


class KindSink:
    """A foreachBatch sink: a table per kind and the dead letters, all of a micro-batch or none."""

    def __init__(self, root: str):
        self.tables = EpochTables(root)

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        docs = batch.select("file", "body").persist()  # parsed once per kind; recomputed from the queue if lost
        try:
            parts = {k: typed(docs, k) for k, spec in DOCUMENT_KINDS.items() if spec.schema}
            self.tables.write(batch.sparkSession, epoch, parts | {"dead_letters": dead_letters(docs)})
        finally:
            docs.unpersist()

    def read(self, spark: SparkSession, kind: str) -> DataFrame:
        schema = DEAD if kind == "dead_letters" else f"file string, {DOCUMENT_KINDS[kind].schema}"
        return self.tables.read(spark, kind, _schema(schema)).drop("epoch")
