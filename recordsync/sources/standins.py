"""Domain tables derived from the driver tables.

The test data is a TPC-H-like star schema; the synchroniser works on ERP and
CRM tables.  Each property below is a lazy DataFrame with the domain schema,
derived from the driver parquet by a fixed rule, so every query's work grows
with the input tables.  Nothing here is collected or materialised.

Mapping (one rule per table):

* clients / branches  <- customer (one branch per client)
* cities / states / countries <- nation / region
* industries / client_industries <- customer market segment
* credit_limit_history <- events
* sales_reps <- supplier
* person / sales_order / items / deliveries <- customer / orders / lineitem
* budget / budget items / tiers / deliveries <- orders / lineitem
* service orders <- orders
* ERP contacts / CRM contacts / incoming contacts / contact changes <- events
* leads (CRM copy of the ERP clients) <- customer with rule-based drift
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import STAGES_ALIAS
from .readers import read_table

DEC = "decimal(18,2)"

# Industry code of each market segment, and region -> country code.
SEGMENT_CODES = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4, "MACHINERY": 5}
REGION_COUNTRY = {0: "AF", 1: "US", 2: "AS", 3: "EU", 4: "ME"}


def _case(col: Column, mapping: dict, otherwise=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(otherwise))


def segment_code(col: Column) -> Column:
    return _case(col, SEGMENT_CODES).cast("bigint")


def country_code(regionkey: Column) -> Column:
    return _case(regionkey, REGION_COUNTRY)


class DomainTables:
    """Lazy domain DataFrames over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        # True once the tables are bucketed on their main keys (see ``stage``).
        self.bucketed = False

    @classmethod
    def from_frames(cls, spark: SparkSession, bucketed: bool = False, **tables: DataFrame) -> "DomainTables":
        """Domain tables of a real deployment: pass the ERP/CRM DataFrames by
        their domain name (``branches=..., leads=..., budget_item=...``).
        Every view and operator then reads them instead of the stand-ins;
        ``bucketed`` tells the measures the inputs are already bucketed on
        their main keys (``STAGE_KEYS``)."""
        t = cls(spark, "")
        unknown = sorted(set(tables) - set(STAGE_KEYS))
        if unknown:
            raise ValueError(f"unknown domain tables: {unknown}")
        t.__dict__.update(tables)
        t.bucketed = bucketed
        return t

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # ---- geography -------------------------------------------------------
    @cached_property
    def cities(self) -> DataFrame:
        n = self.raw("nation")
        return n.select(
            n.n_nationkey.cast("bigint").alias("id"),
            n.n_nationkey.cast("bigint").alias("city_code"),
            n.n_name.alias("city_name"),
            n.n_regionkey.cast("bigint").alias("state_code"),
            country_code(n.n_regionkey).alias("country_code"),
        )

    @cached_property
    def states(self) -> DataFrame:
        r = self.raw("region")
        return r.select(r.r_regionkey.cast("bigint").alias("code"), r.r_name.alias("name"))

    @cached_property
    def countries(self) -> DataFrame:
        r = self.raw("region")
        return r.select(country_code(r.r_regionkey).alias("code"), r.r_name.alias("name"))

    # ---- clients ---------------------------------------------------------
    @cached_property
    def clients(self) -> DataFrame:
        c = self.raw("customer")
        return c.select(c.c_custkey.alias("client_code"), c.c_name.alias("company_name"))

    @staticmethod
    def _branch_cols(c) -> dict:
        k = c.c_custkey
        return {
            "taxid": F.lpad(k.cast("string"), 14, "0"),
            "sales_rep": (k % 10).cast("bigint"),
            "zipcode": F.lpad((k % 99991).cast("string"), 8, "0"),
            "address": F.concat(F.lit("Rua "), c.c_mktsegment, F.lit(" "), c.c_nationkey.cast("string")),
            "number": (k % 997).cast("int"),
            "district": c.c_mktsegment,
            "complement": F.when(k % 4 == 0, F.lit(None).cast("string"))
                           .otherwise(F.concat(F.lit("Sala "), (k % 50).cast("string"))),
            "email": F.concat(F.lit("client"), k.cast("string"), F.lit("@example.com")),
            "tax_registration": F.when(k % 3 == 0, F.lit("ISENTO"))
                                 .otherwise(((k * 7919) % 1000000).cast("string")),
            "phone": F.concat(F.lit("55119"), F.lpad(k.cast("string"), 8, "0")),
        }

    @cached_property
    def branches(self) -> DataFrame:
        c = self.raw("customer")
        k = c.c_custkey
        b = self._branch_cols(c)
        return c.select(
            k.alias("client"),
            F.lit(1).cast("bigint").alias("code"),
            c.c_name.alias("description"),
            b["taxid"].alias("taxid"),
            b["sales_rep"].alias("sales_rep"),
            c.c_nationkey.cast("bigint").alias("city"),
            b["zipcode"].alias("zipcode"),
            b["address"].alias("address"),
            b["number"].alias("number"),
            b["district"].alias("district"),
            b["complement"].alias("complement"),
            b["email"].alias("email"),
            b["tax_registration"].alias("tax_registration"),
            b["phone"].alias("phone"),
            F.when(k % 5 == 0, F.lit(None).cast("bigint")).otherwise(k).alias("id_crm"),
            (k % 2 == 0).alias("integrate_crm"),
        )

    @cached_property
    def industries(self) -> DataFrame:
        c = self.raw("customer")
        return (c.select(c.c_mktsegment.alias("s")).distinct()
                .select(segment_code(F.col("s")).alias("industry"), F.lower("s").alias("description")))

    @cached_property
    def client_industries(self) -> DataFrame:
        c = self.raw("customer")
        main = c.select(c.c_custkey.alias("client"), F.lit(1).cast("bigint").alias("branch"),
                        segment_code(c.c_mktsegment).alias("industry"))
        extra = (c.where(c.c_custkey % 3 == 0)
                 .select(c.c_custkey.alias("client"), F.lit(1).cast("bigint").alias("branch"),
                         (segment_code(c.c_mktsegment) % 5 + 1).cast("bigint").alias("industry")))
        return main.unionByName(extra).withColumn("status", F.lit("A"))

    @cached_property
    def credit_limit_history(self) -> DataFrame:
        e = self.raw("events")
        return e.select(
            e.user_id.alias("client_code"),
            e.event_id.alias("sequence"),
            e.ts.cast("date").alias("date"),
            e.event_type.alias("observations"),
            F.lit("SYSTEM").alias("user"),
        )

    @cached_property
    def sales_reps(self) -> DataFrame:
        s = self.raw("supplier")
        return s.select(s.s_suppkey.alias("code"),
                        F.concat(F.lit("rep"), s.s_suppkey.cast("string"), F.lit("@example.com")).alias("email"))

    # ---- sales orders ----------------------------------------------------
    @cached_property
    def person(self) -> DataFrame:
        c = self.raw("customer")
        return c.select(c.c_custkey.alias("code"), c.c_custkey.alias("key1"), F.lit(1).cast("bigint").alias("key2"))

    @cached_property
    def sales_order(self) -> DataFrame:
        o = self.raw("orders")
        return o.select(F.lit(1).cast("bigint").alias("company_code"), o.o_orderkey.alias("number"),
                        o.o_custkey.alias("pers_code"))

    @cached_property
    def sales_order_item(self) -> DataFrame:
        li = self.raw("lineitem")
        return li.select(F.lit(1).cast("bigint").alias("so_company_code"), li.l_orderkey.alias("so_number"),
                         li.l_linenumber.alias("sequence"), li.l_quantity.cast(DEC).alias("item_qty"),
                         li.l_shipdate.alias("item_date"))

    @cached_property
    def sales_order_item_delivery(self) -> DataFrame:
        li = self.raw("lineitem")
        return li.select(F.lit(1).cast("bigint").alias("sod_company_code"), li.l_orderkey.alias("sod_number"),
                         li.l_linenumber.alias("sequence"), li.l_extendedprice.cast(DEC).alias("unit_value"),
                         F.when(li.l_linestatus == "O", "Y").otherwise("N").alias("billing_client"))

    # ---- budgets ---------------------------------------------------------
    @cached_property
    def budget(self) -> DataFrame:
        o = self.raw("orders")
        return o.select(o.o_orderkey.alias("number"), o.o_custkey.alias("client_billing_code"),
                        F.lit(1).cast("bigint").alias("branch_billing_code"))

    def _order_items(self) -> DataFrame:
        li = self.raw("lineitem")
        o = self.raw("orders")
        keys = li.select(li.l_orderkey.alias("k"), li.l_returnflag.alias("item")).distinct()
        return keys.join(o, keys.k == o.o_orderkey)

    @cached_property
    def budget_item(self) -> DataFrame:
        j = self._order_items()
        return j.select(F.col("k").alias("bdg_number"), "item", F.col("o_orderdate").alias("date"),
                        F.when(F.col("o_orderstatus") == "F", "N").otherwise("Y").alias("generated"))

    @cached_property
    def budget_item_delivery(self) -> DataFrame:
        j = self._order_items()
        k = F.col("k")
        return j.select(k.alias("bit_bdg_number"), F.col("item").alias("bit_item"),
                        F.col("o_custkey").alias("client_code"), F.lit(1).cast("bigint").alias("branch_code"),
                        F.when(k % 7 == 0, "N").otherwise("Y").alias("billing_client"),
                        F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("o_orderdate")).alias("approval_date"))

    @cached_property
    def budget_item_quantity(self) -> DataFrame:
        li = self.raw("lineitem")
        return li.select(li.l_orderkey.alias("bit_bdg_number"), li.l_returnflag.alias("bit_item"),
                         li.l_quantity.cast(DEC).alias("quantity")).distinct()

    @cached_property
    def budget_item_quant_delivery(self) -> DataFrame:
        li = self.raw("lineitem")
        o = self.raw("orders")
        j = li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey)
        ln = F.col("l_linenumber") % 3
        price = F.col("l_extendedprice").cast(DEC)
        return j.select(
            F.col("l_orderkey").alias("bid_bdg_number"), F.col("l_returnflag").alias("bid_item"),
            F.col("l_quantity").cast(DEC).alias("bid_quantity"), F.col("o_custkey").alias("client_code"),
            F.lit(1).cast("bigint").alias("branch_code"), price.alias("price"),
            F.when(ln == 0, F.lit(0).cast(DEC)).when(ln == 1, F.lit(None).cast(DEC))
             .otherwise((price - F.col("l_quantity").cast(DEC)).cast(DEC)).alias("negotiated_price"),
        )

    # ---- service orders --------------------------------------------------
    @cached_property
    def service_order(self) -> DataFrame:
        o = self.raw("orders")
        one = F.lit(1).cast("bigint")
        return o.select(o.o_custkey.alias("client"), one.alias("branch"), one.alias("company_code"),
                        one.alias("branch_code"), one.alias("sales_rep_code"), o.o_orderkey.alias("number"))

    @cached_property
    def service_order_item(self) -> DataFrame:
        o = self.raw("orders")
        one = F.lit(1).cast("bigint")
        return o.select(one.alias("soi_company_code"), one.alias("soi_branch_code"),
                        one.alias("soi_sales_rep_code"), o.o_orderkey.alias("soi_number"),
                        o.o_orderdate.alias("create_date"),
                        F.when(o.o_orderstatus == "F", "C").otherwise(o.o_orderstatus).alias("status"))

    # ---- contacts --------------------------------------------------------
    @staticmethod
    def _email(number: Column) -> Column:
        return F.concat(F.lit("u"), number.cast("string"), F.lit("@x.org"))

    @classmethod
    def _own_email(cls, k: Column) -> Column:
        """Of four contacts the last shares the third's address, so addresses have 0, 1 or 2 contacts."""
        return cls._email(k - F.when(k % 4 == 3, 1).otherwise(0))

    @cached_property
    def contact(self) -> DataFrame:
        """ERP contact table."""
        e = self.raw("events")
        k = e.event_id
        return e.select(
            k.alias("code"),
            F.concat(F.lit("Contact "), k.cast("string")).alias("name"),
            self._own_email(k).alias("email"),
            F.concat(F.lit("5521"), F.lpad(k.cast("string"), 8, "0")).alias("phone"),
            F.when(k % 3 == 0, F.lit(None)).otherwise(F.lit("Buyer")).alias("job_title_desc"),
            (k % 4).cast("bigint").alias("job_title_code"),
            e.user_id.alias("branch_client"),
            F.lit(1).cast("bigint").alias("branch_code"),
            F.when(k % 5 == 0, F.lit(None).cast("bigint")).otherwise(k).alias("id_crm"),
            F.when(k % 2 == 0, "S").otherwise("N").alias("is_primary"),
        )

    @cached_property
    def contact_job_titles(self) -> DataFrame:
        r = self.raw("region")
        return (r.where(r.r_regionkey < 3)
                .select(r.r_regionkey.cast("bigint").alias("job_title_code"), F.initcap(r.r_name).alias("title")))

    @cached_property
    def contacts(self) -> DataFrame:
        """CRM copy of the contacts (drifts from the ERP by rule)."""
        e = self.raw("events").where(F.col("event_id") % 5 != 0)
        k = e.event_id
        return e.select(
            k.alias("id"),
            F.when(k % 7 == 0, F.concat(F.lit("Contato "), k.cast("string")))
             .otherwise(F.concat(F.lit("contact "), k.cast("string"))).alias("name"),
            self._own_email(k).alias("email"),
            F.concat(F.lit("5521"), F.lpad(k.cast("string"), 8, "0")).alias("phone"),
            F.when(k % 3 == 0, F.lit(None)).otherwise(F.lit("buyer")).alias("job_title"),
            e.user_id.cast("string").alias("client_code"),
            (k % 2 == 0).alias("is_primary"),
        )

    @cached_property
    def incoming_contacts(self) -> DataFrame:
        """Contacts arriving from the CRM; of eight, four addresses, each twice."""
        e = self.raw("events")
        k = e.event_id
        return e.select(
            k.alias("id_crm"),
            F.concat(F.lit("Contact "), k.cast("string")).alias("name"),
            F.when(k % 9 == 0, F.lit(None)).otherwise(F.upper(self._email(k - k % 8 + k % 4))).alias("email"),
            F.concat(F.lit("5521"), F.lpad(k.cast("string"), 8, "0")).alias("phone"),
            F.lit("Buyer").alias("job_title"),
            e.user_id.alias("lead_id"),
            (k % 2 == 0).alias("is_primary"),
            F.when(k % 10 == 3, "D").otherwise("A").alias("op"),
            F.when(k % 29 != 0, F.lpad(e.user_id.cast("string"), 14, "0")).alias("lead_taxid"),
        )

    @cached_property
    def contact_changes(self) -> DataFrame:
        """Contact changes as they arrive (seq): of eight, addresses and CRM ids recur and cross; either may lack."""
        e = self.raw("events")
        k = e.event_id
        return e.select(
            k.alias("seq"), F.when(k % 31 != 0, e.user_id).alias("client"), F.concat(F.lit("Change "), k.cast("string")).alias("name"),
            F.when(k % 9 != 0, F.upper(self._email(k - k % 8 + F.floor(k % 8 / 3)))).alias("email"),
            F.concat(F.lit("5521"), F.lpad(k.cast("string"), 8, "0")).alias("phone"),
            F.when(k % 4 != 0, F.lit("Buyer")).alias("job_title"), F.when(k % 2 == 0, "S").otherwise("N").alias("is_primary"),
            F.when(k % 11 != 0, k - k % 8 + (k % 4) * 2 + 1).alias("id_crm"), F.when(k % 10 == 3, "D").when(k % 13 != 0, "A").alias("op"))

    # ---- CRM leads -------------------------------------------------------
    @staticmethod
    def _long_taxid(k: Column) -> Column:
        """Some leads carry tax ids of 15 and 16 characters, which no ERP column holds."""
        return (F.when(k % 41 == 5, F.concat(F.lit("99"), F.lpad(k.cast("string"), 14, "0")))
                .when(k % 41 == 6, F.concat(F.lit("9"), F.lpad(k.cast("string"), 14, "0"))))

    @cached_property
    def leads(self) -> DataFrame:
        c = self.raw("customer").where(F.col("c_custkey") % 3 != 0)
        n = self.raw("nation")
        r = self.raw("region")
        j = (c.join(n, c.c_nationkey == n.n_nationkey)
              .join(r, F.col("n_regionkey") == r.r_regionkey))
        k = F.col("c_custkey")
        b = self._branch_cols(j)
        stages = F.array(*[F.lit(s) for s in STAGES_ALIAS])
        street = F.concat(F.lit("Rua "), F.col("c_mktsegment"), F.lit(" "), F.col("c_nationkey").cast("string"))
        return j.select(
            k.alias("id"),
            F.when(k % 7 == 0, F.concat(F.col("c_name"), F.lit(" LTDA"))).otherwise(F.col("c_name")).alias("name"),
            F.element_at(stages, (k % 8 + 1).cast("int")).alias("stage"),
            self._long_taxid(k).otherwise(k.cast("string")).alias("taxid"),
            F.col("c_mktsegment").alias("industry"),
            F.when(k % 2 == 0, "ERP").otherwise("Site").alias("source"),
            b["phone"].alias("phone"),
            F.when(k % 4 == 1, F.lower(street)).otherwise(street).alias("address_street"),
            b["zipcode"].alias("address_zipcode"),
            F.when(k % 13 == 0, b["number"] + 1).otherwise(b["number"]).cast("int").alias("address_number"),
            b["complement"].alias("address_complement"),
            b["district"].alias("address_district"),
            F.col("n_name").alias("city"),
            F.when(F.col("n_regionkey") == 1, F.col("r_name")).alias("state"),
            F.when(k % 17 == 0, F.lit(99)).otherwise(k % 10).cast("bigint").alias("sales_rep"),
            b["tax_registration"].alias("tax_registration"),
            k.alias("client_code"),
            F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("c_acctbal")).cast(DEC).alias("budget_value"),
            F.when(k % 13 == 0, F.lit(None)).otherwise(F.col("c_acctbal") * 2).cast(DEC).alias("order_value"),
            F.when(k % 2 == 0, F.lit("signup")).alias("financial_analysis"),
        )

    # ---- CRM-side documents ---------------------------------------------
    @cached_property
    def crm_export(self) -> DataFrame:
        """Full CRM lead export (one row per lead, CRM field names).

        Drift rules: some customers are missing (vanished leads), some are
        present only here (new leads), stages use CRM names, a few stage
        names carry a non-breaking space, and a few required fields are
        missing, formatted with punctuation or 'SN' for no house number.
        """
        from ..schemas import STAGES_CANONICAL
        c = self.raw("customer").where(F.col("c_custkey") % 6 != 5)
        n = self.raw("nation")
        r = self.raw("region")
        j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
        k = F.col("c_custkey")
        b = self._branch_cols(j)
        stages = F.array(*[F.lit(s) for s in STAGES_CANONICAL])
        pos = F.when((k % 10 == 0) & (k % 8 > 0), k % 8 - 1).otherwise(k % 8)
        stage = F.element_at(stages, (pos + 1).cast("int"))
        stage = F.when(k % 12 == 1, F.translate(stage, " ", "\u00a0")).otherwise(stage)
        zipc = b["zipcode"]
        return j.select(
            k.alias("id"),
            F.when(k % 23 == 0, F.lit(None)).otherwise(F.col("c_name")).alias("lead"),
            self._long_taxid(k).when(k % 29 == 0, F.lit(None)).when(k % 7 == 3, F.lpad((k + 90000000).cast("string"), 14, "0"))
             .otherwise(F.lpad(k.cast("string"), 14, "0")).alias("cnpj"),
            stage.alias("stage"),
            F.struct(F.col("c_mktsegment").alias("value")).alias("industry"),
            F.struct(F.when(k % 2 == 0, "ERP").otherwise("Site").alias("value")).alias("source"),
            F.concat(F.lit("55.11-9"), F.lpad(k.cast("string"), 8, "0")).alias("phone1"),
            F.concat(F.lit("Rua "), F.col("c_mktsegment"), F.lit(" "), F.col("c_nationkey").cast("string")).alias("street"),
            F.concat(F.substring(zipc, 1, 5), F.lit("-"), F.substring(zipc, 6, 3)).alias("cep"),
            F.when(k % 19 == 0, F.lit("SN")).otherwise(b["number"].cast("string")).alias("number"),
            b["complement"].alias("complement"),
            F.col("c_mktsegment").alias("district"),
            F.when(k % 4 == 2, F.lower(F.col("n_name"))).otherwise(F.col("n_name")).alias("city"),
            F.col("r_name").alias("state"),
        )

    @cached_property
    def custom_field_rows(self) -> DataFrame:
        """CRM custom fields as rows (leadId, id, value); some ids repeat (the
        later row wins) and registration uses 'ISENTO', '99' or '0'."""
        c = self.raw("customer").where(F.col("c_custkey") % 6 != 5)
        k = F.col("c_custkey")
        reg = (F.when(k % 3 == 0, F.lit("ISENTO")).when(k % 7 == 0, F.lit("99")).when(k % 11 == 0, F.lit("0"))
               .otherwise(F.concat(F.lit("1."), ((k * 7919) % 1000000).cast("string"))))
        rows = F.array(
            F.struct(F.lit(1).alias("pos"), F.lit("_cod.gestores").alias("id"), (k % 10).cast("string").alias("value")),
            F.struct(F.lit(2).alias("pos"), F.lit("_inscricaoestadual").alias("id"), reg.alias("value")),
            F.struct(F.lit(3).alias("pos"), F.lit("_analisefinanceira").alias("id"),
                     F.when(k % 2 == 0, F.lit("signup")).otherwise(F.lit("credit ok")).alias("value")),
            F.struct(F.lit(4).alias("pos"), F.lit("_cod.cliente").alias("id"), k.cast("string").alias("value")),
            F.struct(F.lit(5).alias("pos"), F.lit("_cod.gestores").alias("id"),
                     F.when(k % 5 == 0, (k % 7).cast("string")).alias("value")),
        )
        return (c.select(k.alias("leadId"), F.explode(rows).alias("f"))
                .where(F.col("f.value").isNotNull())
                .select("leadId", F.col("f.pos").alias("pos"), F.col("f.id").alias("id"), F.col("f.value").alias("value")))

    @cached_property
    def sale_lines(self) -> DataFrame:
        """Sold products: one row per (sale, product) with a final value that is
        sometimes missing; lead = the buying customer."""
        li = self.raw("lineitem")
        o = self.raw("orders")
        j = li.join(o.select("o_orderkey", "o_custkey", "o_orderdate"), li.l_orderkey == o.o_orderkey)
        return j.select(
            F.col("o_custkey").alias("lead_id"), F.col("l_orderkey").alias("sale_id"),
            F.col("l_linenumber").cast("bigint").alias("line"),
            F.col("l_partkey").alias("product_id"),
            F.when(F.col("l_linenumber") % 5 == 0, F.lit(None)).otherwise(F.col("l_extendedprice")).cast(DEC)
             .alias("final_value"),
            F.col("o_orderdate").alias("sale_date"))

    @cached_property
    def crm_contacts(self) -> DataFrame:
        """CRM contact export (CRM field names), one row per contact."""
        e = self.raw("events")
        k = e.event_id
        return e.select(
            k.alias("id"), e.user_id.alias("leadId"),
            F.concat(F.lit("Contact "), k.cast("string")).alias("name"),
            F.when(k % 9 == 0, F.lit(None)).otherwise(self._own_email(k)).alias("email"),
            F.concat(F.lit("5521"), F.lpad(k.cast("string"), 8, "0")).alias("phone1"),
            F.when(k % 3 == 0, F.lit(None)).otherwise(F.lit("Buyer")).alias("jobTitle"),
            F.when(k % 2 == 0, "true").otherwise("false").alias("mainContact"),
        )

    @cached_property
    def queue_documents(self) -> DataFrame:
        """Queue documents (seq, file, body): the event's type tells the kind; some files have a foreign name, some bodies
        are cut short or have a key that no schema knows."""
        e = self.raw("events")
        k = e.event_id

        def text(*parts) -> Column:
            return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
        prefix = F.when(k % 53 == 7, "misc_")
        for event, kind in (("click", "update_leads_in_erp_"), ("purchase", "converted_lead_"), ("error", "lead_descartada_"),
                            ("view", "contato_update_erp_"), ("signup", "inserted_timeline_")):
            prefix = prefix.when(e.event_type == event, kind)
        extra = F.when(k % 41 == 3, F.lit(',"Score":1')).otherwise(F.lit(""))
        lead = text('{"Lead":{"Id":', e.user_id, ',"Company":"Company ', e.user_id, '","Stage":"', e.event_type, '","Address":{"City":"C',
                    k % 25, '"', F.when(k % 43 == 5, F.lit(',"Floor":"2"')).otherwise(F.lit("")), '}', extra, '}}')
        contact = text('{"Id":', k, ',"Name":"Person ', k, '","Email":"p', k, '@x.org"', extra, '}')
        note = text('{"Id":', k, ',"LeadId":', e.user_id, ',"Text":"note ', k, '"', extra, '}')
        body = F.when(e.event_type == "view", contact).when(e.event_type == "signup", note).otherwise(lead)
        return e.select(k.alias("seq"), text(prefix, k, ".json").alias("file"),
                        F.when(k % 37 == 11, F.substring(body, F.lit(1), F.length(body) - 3)).otherwise(body).alias("body"))

    @cached_property
    def landed_pages(self) -> DataFrame:
        """CRM listings (one per market segment) as landed pages (listing, page, value), 100 ids to a page.  Some leads moved
        to the next page while the listing was read; one listing lacks its end, one a page."""
        c = self.raw("customer")
        page = F.floor(F.col("c_custkey") / 100)
        item = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("lead"))
        own = c.select(F.col("c_mktsegment").alias("listing"), page.alias("page"), item.alias("item"))
        top = c.groupBy("c_mktsegment").agg(F.max(page).alias("_top"))
        moved = c.where(F.col("c_custkey") % 50 == 0).join(top, "c_mktsegment").where(page < F.col("_top")).select(
            F.col("c_mktsegment").alias("listing"), (page + 1).alias("page"),
            F.struct(F.col("c_custkey").alias("id"), F.concat("c_name", F.lit(" (moved)")).alias("lead")).alias("item"))
        full = own.unionByName(moved).groupBy("listing", "page").agg(F.collect_list("item").alias("value"))  # a page at most
        full = full.where((F.col("listing") != "BUILDING") | (F.col("page") != 0))
        ends = c.groupBy(F.col("c_mktsegment").alias("listing")).agg((F.max(page) + 1).alias("page")).where(
            "listing <> 'AUTOMOBILE'").select("listing", "page", F.array().cast(full.schema["value"].dataType).alias("value"))
        return full.unionByName(ends)

    @cached_property
    def error_log(self) -> DataFrame:
        """The error log as it stands: one row per event."""
        e = self.raw("events")
        return e.select(F.col("event_id").alias("log_id"), e.ts.alias("created_on"), e.event_type.alias("error_info"))

    @cached_property
    def lead_docs(self) -> DataFrame:
        """Per CRM lead: its custom fields as an array of {id, value} in CRM
        order (a repeated id: the later one wins)."""
        c = self.raw("customer").where(F.col("c_custkey") % 6 != 5)
        k = F.col("c_custkey")
        reg = (F.when(k % 3 == 0, F.lit("ISENTO")).when(k % 7 == 0, F.lit("99")).when(k % 11 == 0, F.lit("0"))
               .otherwise(F.concat(F.lit("1."), ((k * 7919) % 1000000).cast("string"))))
        arr = F.array(
            F.struct(F.lit("_cod.gestores").alias("id"), (k % 10).cast("string").alias("value")),
            F.struct(F.lit("_inscricaoestadual").alias("id"), reg.alias("value")),
            F.struct(F.lit("_analisefinanceira").alias("id"),
                     F.when(k % 2 == 0, F.lit("signup")).otherwise(F.lit("credit ok")).alias("value")),
            F.struct(F.lit("_cod.cliente").alias("id"), k.cast("string").alias("value")),
            F.struct(F.lit("_cod.gestores").alias("id"), F.when(k % 5 == 0, (k % 7).cast("string")).alias("value")),
        )
        return c.select(k.alias("id"), F.filter(arr, lambda x: x["value"].isNotNull()).alias("CustomFields"))

    @cached_property
    def webhook_docs(self) -> DataFrame:
        """CRM webhook documents, one per event: lead id = user, kind = event
        type, the stage in CRM (canonical) names and the raw JSON text, which
        carries only some keys (``Phone`` sometimes present with null)."""
        from ..schemas import STAGES_CANONICAL
        e = self.raw("events")
        k = e.event_id
        stages = F.array(*[F.lit(s) for s in STAGES_CANONICAL])
        stage = F.element_at(stages, (k % 8 + 1).cast("int"))
        company = F.concat(F.lit("Company "), e.user_id.cast("string"), F.lit(" "), (k % 3).cast("string"),
                           F.when(k % 9 == 0, F.lit(" Comercio Industria e Servicos Limitada")).otherwise(F.lit("")))
        phone = F.concat(F.lit("5531"), F.lpad(k.cast("string"), 8, "0"))
        zipc = F.lpad((k % 99991).cast("string"), 8, "0")
        zip_fmt = F.concat(F.substring(zipc, 1, 5), F.lit("-"), F.substring(zipc, 6, 3))
        contact = lambda n: F.struct(
            (k * 10 + n).alias("Id"), e.user_id.alias("LeadId"),
            F.concat(F.lit(f"Person {n} of "), k.cast("string")).alias("Name"),
            F.concat(F.lit("p"), F.lit(str(n)), F.lit("."), k.cast("string"), F.lit("@x.org")).alias("Email"),
            phone.alias("Phone"), F.lit("Buyer").alias("Position"))
        contacts = F.when(k % 2 == 0, F.array(contact(1), contact(2))).otherwise(F.array(contact(1)))
        raw = F.concat(
            F.lit('{"Lead":{"Id":'), e.user_id.cast("string"),
            F.when(k % 3 == 0, F.concat(F.lit(',"Company":"'), company, F.lit('"'))).otherwise(F.lit("")),
            F.when(k % 4 == 0, F.lit(',"Phone":null'))
             .when(k % 4 == 1, F.concat(F.lit(',"Phone":"'), phone, F.lit('"'))).otherwise(F.lit("")),
            F.when(k % 5 == 0, F.concat(F.lit(',"CpfCnpj":"'), F.lpad(e.user_id.cast("string"), 14, "0"), F.lit('"')))
             .otherwise(F.lit("")),
            F.when(k % 6 == 0, F.concat(F.lit(',"Address":{"ZipCode":"'), zip_fmt, F.lit('","City":"Cidade '),
                                        (k % 25).cast("string"), F.lit('"}'))).otherwise(F.lit("")),
            F.when(k % 7 == 0, F.concat(F.lit(',"CustomFields":[{"id":"_cod.gestores","value":"'),
                                        (k % 10).cast("string"), F.lit('"},{"id":"_cod.gestores","value":"x"}]')))
             .otherwise(F.lit("")),
            F.lit(',"Stage":"'), stage, F.lit('"}}'))
        return e.select(
            k.alias("doc_id"), e.ts.alias("received_at"), e.event_type.alias("kind"), e.user_id.alias("lead_id"),
            stage.alias("stage"), company.alias("company"), contacts.alias("contacts"), raw.alias("raw"))

# Main key of each domain table: staged files are hash-partitioned on it, so
# scans run in parallel and rows of one key sit in one file.
STAGE_KEYS = {
    "cities": "id", "states": "code", "countries": "code", "clients": "client_code", "branches": "client",
    "industries": "industry", "client_industries": "client", "credit_limit_history": "client_code",
    "sales_reps": "code", "person": "code", "sales_order": "number", "sales_order_item": "so_number",
    "sales_order_item_delivery": "sod_number", "budget": "number", "budget_item": "bdg_number",
    "budget_item_delivery": "bit_bdg_number", "budget_item_quantity": "bit_bdg_number",
    "budget_item_quant_delivery": "bid_bdg_number", "service_order": "number", "service_order_item": "soi_number",
    "contact": "branch_client", "contact_job_titles": "job_title_code", "contacts": "id",
    "incoming_contacts": "id_crm", "contact_changes": "seq", "leads": "id", "crm_export": "id", "custom_field_rows": "leadId",
    "sale_lines": "lead_id", "crm_contacts": "id", "lead_docs": "id", "webhook_docs": "lead_id",
}


def stage(t: DomainTables, root: str, partitions: int | None = None, parallel: int = 8,
          bucketed: bool = True) -> DomainTables:
    """Write every domain table once under ``root`` (shared storage); the
    result reads the written copies, ``t`` stays as it is.

    This is the staging step a deployment has anyway (the ERP/CRM extracts
    land as tables); queries then read domain tables instead of re-deriving
    them from the driver tables each time.  With ``bucketed`` the tables are
    bucketed on their main key into ``partitions`` buckets (external tables
    at ``root``, registered in the session catalog), so joins and windows on
    that key (budget number, order number, client) read co-located buckets
    without a shuffle; otherwise rows are just hash-partitioned into files.
    The rows of keys that hold a multiple of a bucket's share are written
    beside, evenly over ``n`` files, and read with the others: such a table
    is shuffled again, after partial aggregates, but no task has it all.
    The writes are independent Spark jobs, submitted from ``parallel``
    threads so small ones share the cluster instead of queueing.
    """
    import uuid
    from concurrent.futures import ThreadPoolExecutor

    from ..operators.skew import hot_keys, split_hot
    n = partitions or int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    root = root.rstrip("/")
    tag = uuid.uuid4().hex[:8]
    frames = {name: getattr(t, name) for name in STAGE_KEYS}  # plans built on this thread

    def write(name: str) -> tuple[str, str | None]:
        path, key, rows, beside = f"{root}/{name}", STAGE_KEYS[name], frames[name], None
        hot = hot_keys(rows, key, n)
        if hot:  # a bucket is one task's: what would swell it goes beside the buckets, evenly
            of_hot, rows = split_hot(rows, key, hot)
            beside = f"{path}__hot"
            of_hot.repartition(n).write.mode("overwrite").parquet(beside)
        w = rows.repartition(n, key).write.mode("overwrite")
        if bucketed:
            table = f"rs_{tag}_{name}"
            w.bucketBy(n, key).option("path", path).saveAsTable(table)
            return table, beside
        w.parquet(path)
        return path, beside

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        written = dict(zip(STAGE_KEYS, pool.map(write, STAGE_KEYS)))
    staged = DomainTables(t.spark, t.sf_dir)
    for name, (where, beside) in written.items():
        table = t.spark.table(where) if bucketed else t.spark.read.parquet(where)
        staged.__dict__[name] = table.unionByName(t.spark.read.parquet(beside)) if beside else table
    staged.bucketed = bucketed
    return staged
