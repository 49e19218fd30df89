"""The client cascade as a trigger: what each micro-batch of CRM lead changes does to the ERP.

The source fires a row trigger that writes six tables.  Here a micro-batch writes them, and the updates of branches it
matches, as one epoch of ``EpochTables``: the codes of new clients come from an ``IdLedger``, and what earlier epochs made
is part of the ERP that the next one meets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cascade import client_cascade
from ..session import cut_lineage
from .epochs import EpochTables, IdLedger

#: Output of the cascade: the table that its rows are added to.
TABLES = {"new_branches": "branches", "new_clients": "clients", "new_sales_rep_branches": "sales_rep_branches",
          "new_billing_addresses": "billing_addresses", "new_credit_limit_history": "credit_limit_history",
          "new_client_industries": "client_industries", "credit_limit_history": "credit_limit_history",
          "branch_updates": "branch_updates", "client_industries": "industry_updates", "rejects": "rejects"}
_HISTORY = ["client_code", "sequence", "observations"]
_UPDATED = ["tax_registration", "sales_rep", "phone", "id_crm", "integrate_crm"]


class CascadeSink:
    """A foreachBatch sink: all tables of a micro-batch or none; a replayed micro-batch changes nothing.

    ``client_view`` (the ERP's client rows with ``industry``), ``branches``, ``history`` (client_code, sequence) are the
    ERP before the stream; ``cities``, ``states`` and ``industries`` are look-ups.  ``prepare`` makes lead changes of a
    micro-batch.
    """

    def __init__(self, root: str, client_view: DataFrame, branches: DataFrame, cities: DataFrame, states: DataFrame,
                 history: DataFrame, industries: DataFrame, prepare=lambda batch: batch):
        self.tables = EpochTables(root)
        self.client_view, self.branches, self.history = client_view, branches, history
        self.cities, self.states, self.industries, self.prepare = cities, states, industries, prepare
        start = branches.agg(F.coalesce(F.max("client"), F.lit(0)).cast("bigint")).first()[0]
        self.codes = IdLedger(root, "client", start)
        self.schemas: dict = {}

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        if epoch in self.tables.manifests(spark):
            return
        changes = cut_lineage(self.prepare(batch))
        self.tables.write(spark, epoch, {} if changes.isEmpty() else self.run(changes, epoch))

    def run(self, changes: DataFrame, epoch: int) -> dict[str, DataFrame]:
        """The rows that the micro-batch adds to each table."""
        spark = changes.sparkSession
        out = client_cascade(changes, self.clients_before(spark, epoch), self.branches_before(spark, epoch), self.cities,
                             self.states, self.history_before(spark, epoch), self.industries,
                             claim=self.codes.for_epoch(spark, epoch))
        added: dict[str, DataFrame] = {}
        for name, table in TABLES.items():
            rows = out[name].select(*_HISTORY) if table == "credit_limit_history" else out[name]
            added[table] = added[table].unionByName(rows) if table in added else rows
        self.schemas = {table: rows.schema for table, rows in added.items()}
        return added

    def _added(self, spark, table: str, epoch: int | None) -> DataFrame | None:
        """Rows of a table from the epochs before one; None if there are none."""
        there = [(e, m.attempt) for e, m in self.tables.manifests(spark).items()
                 if table in m.tables and (epoch is None or e < epoch)]
        if not there:
            return None
        if table not in self.schemas:  # a restart: the files tell
            last, attempt = max(there)
            self.schemas[table] = spark.read.parquet(f"{self.tables.root}/{table}/epoch={last}/attempt={attempt}").schema
        return self.tables.read(spark, table, self.schemas[table], epoch)

    def branches_before(self, spark, epoch: int | None = None) -> DataFrame:
        """client, code and taxid of all branches."""
        keys = [F.col("client").cast("bigint").alias("client"), F.col("code").cast("bigint").alias("code"), "taxid"]
        added = self._added(spark, "branches", epoch)
        known = self.branches.select(*keys)
        return known if added is None else known.unionByName(added.select(*keys))

    def history_before(self, spark, epoch: int | None = None) -> DataFrame:
        added = self._added(spark, "credit_limit_history", epoch)
        known = self.history.select("client_code", "sequence")
        return known if added is None else known.unionByName(added.select("client_code", "sequence"))

    def clients_before(self, spark, epoch: int | None = None) -> DataFrame:
        """The client view with what the stream changed so far."""
        view = self.client_view
        new, updates = self._added(spark, "branches", epoch), self._added(spark, "branch_updates", epoch)
        if new is None:
            return view
        names = {"client": "client_code", "code": "branch_code", "description": "company_name", "address": "address_street",
                 "district": "address_district", "zipcode": "address_zipcode", "number": "address_number",
                 "complement": "address_complement", "city": "city_code"}
        trade = self.industries.groupBy("industry").agg(F.min("description").alias("_name"))
        of = self._added(spark, "client_industries", epoch).join(trade, "industry").select(
            F.col("client").alias("_client"), F.col("_name"))
        rows = new.join(of, new["client"] == F.col("_client"), "left").withColumnsRenamed(names)
        rows = rows.withColumn("industry", F.col("_name")).withColumn("integrate_crm", F.lit("Y"))
        rows = rows.select(*[F.col(c).cast(view.schema[c].dataType).alias(c) if c in rows.columns
                             else F.lit(None).cast(view.schema[c].dataType).alias(c) for c in view.columns])
        last = updates.groupBy(F.col("client").alias("_c"), F.col("code").alias("_b")).agg(
            F.max_by(F.struct(*_UPDATED), F.struct("epoch", "lead_id")).alias("_u"))
        trades = self._added(spark, "industry_updates", epoch).groupBy(F.col("client").alias("_ic"), F.col("branch").alias("_ib")).agg(
            F.max_by("industry", "epoch").alias("_code")).join(trade, F.col("_code") == F.col("industry")).select("_ic", "_ib", "_name")
        every = view.unionByName(rows)
        every = every.join(last, (F.col("client_code") == F.col("_c")) & (F.col("branch_code") == F.col("_b")), "left").join(
            trades, (F.col("client_code") == F.col("_ic")) & (F.col("branch_code") == F.col("_ib")), "left")

        def now(c: str):
            if c in _UPDATED:
                return F.when(F.col("_c").isNotNull(), F.col(f"_u.{c}")).otherwise(F.col(c)).cast(view.schema[c].dataType).alias(c)
            return F.coalesce("_name", "industry").alias(c) if c == "industry" else F.col(c)
        return every.select(*[now(c) for c in view.columns])

    def table(self, spark, name: str) -> DataFrame | None:
        """All rows that the stream added to a table."""
        return self._added(spark, name, None)
