"""Readers: parquet tables, JDBC tables, JSON queues and CRM exports.

All readers take an explicit schema where the input is a document (JSON), so
no inference pass runs over 100 TB of files, and return lazy DataFrames so
Catalyst pushes filters and column pruning into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


_SCHEMAS: dict[str, T.StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table (S1 for files).

    The schema is read from the footers once per path and then passed
    explicitly, so building a plan that scans a table many times does not
    re-read footers on the driver each time.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    if schema is None:
        schema = _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(schema).parquet(path)


REQUIRED_JDBC = ("url", "user", "password", "driver")


def jdbc_options(settings: dict) -> dict:
    """Connection settings; fail when any required one is missing.

    Values are never logged.
    """
    missing = [k for k in REQUIRED_JDBC if not settings.get(k)]
    if missing:
        raise ValueError(f"missing connection settings: {', '.join(missing)}")
    return {k: str(v) for k, v in settings.items() if v is not None}


def read_jdbc(spark: SparkSession, settings: dict, table: str, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int | None = None,
              fetchsize: int = 10000) -> DataFrame:
    """JDBC scan.

    A table or parenthesised sub-query goes in ``dbtable`` (``query`` cannot
    be combined with partitioning), and a numeric column with bounds splits
    the read over ``num_partitions`` parallel connections instead of one.
    """
    opts = jdbc_options(settings)
    r = spark.read.format("jdbc").options(**opts).option("dbtable", table).option("fetchsize", fetchsize)
    if partition_column:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("partition_column needs lower, upper and num_partitions")
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def lower_case_columns(df: DataFrame) -> DataFrame:
    """S3: canonical lower-case keys."""
    return df.toDF(*[c.lower() for c in df.columns])


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None) -> DataFrame:
    """JSON-lines batch scan with an explicit schema and optional file glob."""
    r = spark.read.schema(schema).option("mode", "PERMISSIVE")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return lower_case_columns(r.json(path))


def read_documents(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None,
                   corrupt_column: str = "_corrupt_record") -> DataFrame:
    """S4/S5/Q-5: one JSON document (object or array) per file.

    Arrays become rows; unparsable files keep their text in the corrupt column
    and the source file name in ``source_file`` for lineage.
    """
    fields = list(schema.fields)
    if corrupt_column not in schema.fieldNames():
        fields.append(T.StructField(corrupt_column, T.StringType()))
    r = (spark.read.schema(T.StructType(fields)).option("multiLine", True)
         .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_column))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.json(path).withColumn("source_file", F.col("_metadata.file_path"))


def explode_pages(pages: DataFrame, items_col: str = "value") -> DataFrame:
    """Landed API pages ``{value: [...]}`` -> one row per item.

    Empty pages (the end-of-listing marker) contribute no rows; the page
    number is kept so completeness can be checked with ``page_completeness``.
    """
    return pages.select("*", F.posexplode(items_col).alias("pos", "item")).drop(items_col)


def page_completeness(pages: DataFrame, page_col: str = "page", items_col: str = "value") -> DataFrame:
    """Pages fetched, items seen, and whether an empty terminating page exists."""
    return pages.agg(
        F.count("*").alias("pages"),
        F.sum(F.size(items_col)).cast("bigint").alias("items"),
        F.max((F.size(items_col) == 0).cast("int")).cast("boolean").alias("complete"),
    )


def listing_report(pages: DataFrame, items_col: str = "value") -> DataFrame:
    """Per ``listing`` of landed pages (listing, page from 0, items): pages, items, the numbers missing between the
    first and the last page, whether an empty page ends it, and ``status``: complete, unfinished (no empty page at its end)
    or holed.  Items are not read: their number per page is enough."""
    n = F.size(items_col)
    per_page = pages.select("listing", "page", n.alias("n")).groupBy("listing", "page").agg(F.max("n").alias("n"))
    seen = per_page.groupBy("listing").agg(
        F.count("*").alias("pages"), F.sum("n").cast("bigint").alias("items"), F.max("page").alias("_last"),
        F.max(F.when(F.col("n") == 0, F.col("page"))).alias("_end"))
    missing = (F.col("_last") + 1 - F.col("pages")).cast("bigint")
    ended = F.coalesce(F.col("_end") == F.col("_last"), F.lit(False))
    return seen.select("listing", "pages", "items", missing.alias("missing"), ended.alias("ended"),
                       F.when(missing > 0, "holed").when(ended, "complete").otherwise("unfinished").alias("status"))


def explode_listings(pages: DataFrame, items_col: str = "value", item_key: str = "id") -> DataFrame:
    """The items of complete listings, (listing, page, item); a listing that is unfinished or holed is held back (see
    ``listing_report``).  An item that moved while the listing was read stands on two pages and is taken from the later."""
    complete = listing_report(pages, items_col).where("status = 'complete'").select("listing")
    items = pages.join(complete, "listing", "left_semi").select("listing", "page", F.explode(items_col).alias("item"))
    return items.groupBy("listing", F.col(f"item.{item_key}").alias("_key")).agg(
        F.max_by(F.struct("page", "item"), "page").alias("_last")).select("listing", "_last.page", "_last.item")
