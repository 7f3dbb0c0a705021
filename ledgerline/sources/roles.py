"""Role views: the warehouse and operational tables the reports read, derived
from the driver tables (mapping in FIXTURES.md).

A real deployment points these names at its own tables; every plan in
``ledgerline.plans`` only sees the role frames, never the driver tables.
All derivations are narrow projections or one equi-join, so they stay inside
the scan's codegen stage and keep column pruning / filter pushdown.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.semantics import MONEY, PERCENT, RATE
from ledgerline.sources.driver import DriverTables

col = F.col


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _file_no(key: Column) -> Column:
    return F.concat(F.lit("AF"), _pad(key, 8))


def _site(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), _pad(key, 3), F.lit("-0000"))


# The small dimension rows (key, name) / bands used by the
# commission report. Sizes are constant, so broadcasting them is safe.
USAGE_TYPES = [(1, "Fee"), (2, "fixed fee"), (3, "Package")]
COMMISSION_BANDS = [  # key, age_min, age_max, pay_percent, is_delete
    (1, 0, 365, "10.00", 0),
    (2, 366, 730, "7.50", 0),
    (3, 731, 1095, "5.00", 0),
    (4, 1096, 1461, "2.50", 0),
    (5, 1462, 9999, "1.00", 0),
    (6, 0, 30, "99.00", 1),
    (7, 10000, 12000, None, 0),
]
NEW_BUSINESS_BANDS = [(0, 365), (366, 730), (731, 1095), (1096, 1461), (1462, 9999)]
# The client request-status codes (the event types of the
# driver's events table); each account has one description per status.
REQUEST_STATUSES = ("click", "error", "purchase", "signup", "view")


class Roles:
    """All role frames over one driver directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.t = DriverTables(spark, sf_dir)

    # ---------------------------------------------------------------- inline
    def _values(self, rows, columns: list[tuple[str, str]]) -> DataFrame:
        """A literal table as a ``VALUES`` relation (a LocalRelation: no RDD,
        no job to broadcast it, a stable plan for size-check caching)."""
        def lit(v):
            if v is None:
                return "NULL"
            return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
        body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
        names = ", ".join(n for n, _ in columns)
        casts = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in columns)
        return self.spark.sql(f"SELECT {casts} FROM VALUES {body} AS t({names})")

    @cached_property
    def usage_type(self) -> DataFrame:
        return self._values(USAGE_TYPES, [("usage_type_key", "int"), ("usage_type_name", "string")])

    @cached_property
    def commission_band(self) -> DataFrame:
        rows = [(k, lo, hi, None if p is None else Decimal(p), d)
                for k, lo, hi, p, d in COMMISSION_BANDS]
        return self._values(rows, [("commission_key", "int"), ("account_age_min", "int"),
                                   ("account_age_max", "int"),
                                   ("account_pay_percent", "decimal(5,2)"), ("is_delete", "int")])

    @cached_property
    def new_business_band(self) -> DataFrame:
        return self._values(NEW_BUSINESS_BANDS, [("start_range", "int"), ("end_range", "int")])

    # ------------------------------------------------------------- warehouse
    @cached_property
    def file(self) -> DataFrame:
        o = self.t.orders
        return o.select(
            col("o_orderkey").alias("file_key"),
            F.when((col("o_orderstatus") == "P") & (col("o_orderkey") % 10 == 0), 1)
             .otherwise(0).alias("is_delete"),
        )

    @cached_property
    def component(self) -> DataFrame:
        p = self.t.part
        return p.select(
            col("p_partkey").alias("component_key"),
            F.when(col("p_size") > 45, 1).otherwise(0).alias("charge_as_fee"),
        )

    @cached_property
    def client(self) -> DataFrame:
        c = self.t.customer
        seg = col("c_mktsegment")
        key = col("c_custkey")
        return c.select(
            key.alias("client_key"),
            col("c_name").alias("company_name1"),
            F.when(seg == "BUILDING", "REG").when(seg == "MACHINERY", "reg ")
             .when(seg == "HOUSEHOLD", "spc").when(seg == "FURNITURE", "SPC")
             .otherwise("OTH").alias("commission_type"),
            F.nullif(key % 11, F.lit(5)).cast(PERCENT).alias("commission_percent"),
            F.concat(F.lit("  Exec "), col("c_nationkey").cast("string"), F.lit(" "))
             .alias("account_executive"),
            col("c_nationkey").alias("account_executive_id"),
            F.when(key % 97 == 0, F.lit(None).cast("date"))
             .otherwise(F.date_add(F.lit(dt.date(1995, 1, 1)), (key * 7 % 1500).cast("int")))
             .alias("business_start_date"),
            _site("SITE", col("c_nationkey")).alias("site_number"),
        )

    def _billed(self, lines: DataFrame, *more: str) -> DataFrame:
        o = self.t.orders.select("o_orderkey", "o_custkey")
        ship = col("l_shipdate")
        return lines.join(o, lines.l_orderkey == o.o_orderkey, "inner").select(
            col("l_orderkey").alias("file_key"),
            col("o_custkey").alias("client_key"),
            col("l_partkey").alias("component_key"),
            (col("l_linenumber") % 3 + 1).alias("usage_type_key"),
            col("l_quantity").cast(MONEY).alias("quantity"),
            col("l_extendedprice").cast(MONEY).alias("unit_price"),
            F.to_date(ship).alias("billing_date"),
            (F.year(ship) * 10000 + F.month(ship) * 100 + F.dayofmonth(ship))
             .cast("int").alias("billing_date_key"),
            F.when((col("l_returnflag") == "R") & (col("l_linestatus") == "F"), 1)
             .otherwise(0).alias("is_delete"),
            F.when(col("l_returnflag") == "A", 0).otherwise(1).alias("is_billed"),
            *more,
        )

    @cached_property
    def billed_line(self) -> DataFrame:
        return self._billed(self.t.lineitem)

    @cached_property
    def billed_component(self) -> DataFrame:
        """Billed lines with their component's columns. The component join
        comes before the joins by file, the fixture's own one included."""
        li, c = self.t.lineitem, self.component
        return self._billed(li.join(c, li.l_partkey == c.component_key).drop("component_key"), "charge_as_fee")

    @cached_property
    def file_fees(self) -> DataFrame:
        o = self.t.orders
        return o.where(col("o_orderkey") % 4 != 0).select(
            col("o_orderkey").alias("file_key"),
            F.when(col("o_orderpriority") == "5-LOW", F.lit(None).cast(MONEY))
             .otherwise(col("o_totalprice").cast(MONEY)).alias("miscellaneous_fees"),
            (col("o_orderkey") % 50).cast(MONEY).alias("background_fees"),
        )

    @cached_property
    def invoice_adjustment(self) -> DataFrame:
        o = self.t.orders
        c = self.t.customer.select("c_custkey", "c_nationkey")
        m = F.month("o_orderdate").cast("string")
        from_orders = o.join(c, o.o_custkey == c.c_custkey, "inner").select(
            col("o_custkey").alias("client_key"),
            col("c_nationkey").alias("account_executive_id"),
            F.when(col("o_orderkey") % 500 == 0, m).otherwise(F.lpad(m, 2, "0"))
             .alias("adjustment_month"),
            F.year("o_orderdate").cast("string").alias("adjustment_year"),
            (col("o_orderkey") % 90).cast(MONEY).alias("adjustment_amount"),
            F.nullif(col("o_orderkey") % 30, F.lit(20)).cast(MONEY).alias("bad_debt_amount"),
            (col("o_orderkey") % 70).cast(MONEY).alias("amount"),
            F.nullif(col("o_orderkey") % 40, F.lit(10)).cast(MONEY).alias("fee"),
        )
        e = self.t.events.where(col("event_type") == "purchase")
        late = e.join(c, e.user_id == c.c_custkey, "inner").select(
            col("user_id").alias("client_key"),
            col("c_nationkey").alias("account_executive_id"),
            F.lpad(F.month("ts").cast("string"), 2, "0").alias("adjustment_month"),
            F.year("ts").cast("string").alias("adjustment_year"),
            (col("event_id") % 90).cast(MONEY).alias("adjustment_amount"),
            col("value").cast(MONEY).alias("bad_debt_amount"),
            (col("event_id") % 70).cast(MONEY).alias("amount"),
            F.lit(None).cast(MONEY).alias("fee"),
        )
        return from_orders.unionByName(late)

    @cached_property
    def site_bucket(self) -> DataFrame:
        n = self.t.nation
        key = col("n_nationkey")
        # Every fifth site carries two bucket months, the others one.
        months = F.when(key % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        return n.select(
            _site("SITE", key).alias("site_number"),
            F.explode(months).alias("bucket_month"),
            F.concat(F.lit("Bucket "), (key % 4).cast("string")).alias("bucket_name"),
            F.lit(10).cast(RATE).alias("yr1_rate"),
            (key % 9).cast(RATE).alias("yr2_rate"),
            F.nullif(key % 3, F.lit(1)).cast(RATE).alias("yr3_rate"),
            F.lit(1).cast(RATE).alias("perpetual_rate"),
        )

    # ------------------------------------------------------------ operational
    @cached_property
    def request(self) -> DataFrame:
        o = self.t.orders
        c = self.t.customer.select("c_custkey", "c_nationkey", "c_mktsegment", "c_name")
        k = col("o_orderkey")
        st = col("o_orderstatus")
        return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
            _file_no(k).alias("file_no"),
            _site("Site", col("c_nationkey")).alias("site_no"),
            F.when(k % 6 == 0, F.lit(None).cast("string")).otherwise(col("o_orderpriority"))
             .alias("batch_no"),
            col("c_mktsegment").alias("first_name"),
            col("c_name").alias("last_name"),
            F.to_date("o_orderdate").alias("date_requested"),
            col("o_orderdate").alias("date_completed"),
            col("o_orderpriority").alias("requester"),
            F.when(st == "F", "CLOSED").when(st == "O", "closed ").otherwise("PENDING")
             .alias("status"),
            F.when(k % 3 == 0, F.lit("none"))
             .otherwise(F.concat(F.lit("PKG"), (k % 3).cast("string"))).alias("package"),
            F.when(k % 5 == 0, 1).when(k % 5 == 1, F.lit(None).cast("int")).otherwise(0)
             .alias("trouble_flag"),
            F.when(k % 5 == 0, "view").when(k % 5 == 1, "signup").when(k % 5 == 2, "error")
             .when(k % 5 == 3, "click").otherwise("purchase").alias("client_req_status"),
            col("c_nationkey").alias("account_no"),
        )

    @cached_property
    def request_detail(self) -> DataFrame:
        li = self.t.lineitem
        p = self.t.part.select("p_partkey", "p_type", "p_brand")
        ln = col("l_linenumber")
        pk = col("l_partkey")
        rf = col("l_returnflag")
        return li.join(p, li.l_partkey == p.p_partkey, "inner").select(
            _file_no(col("l_orderkey")).alias("file_no"),
            ln.alias("line_no"),
            col("l_extendedprice").cast(MONEY).alias("unit_price"),
            col("l_shipdate").alias("date_completed"),
            F.when(rf == "R", F.lit(None).cast("string")).when(rf == "A", F.lit("  "))
             .otherwise(col("p_type")).alias("report_desc"),
            col("p_brand").alias("report_type"),
            F.when(ln == 1, "P").when(ln == 2, "F1").when(ln == 3, "f")
             .when(ln == 4, F.lit(None).cast("string")).otherwise("A").alias("type_code"),
            F.when(pk % 10 == 0, "NOTREQ").when(pk % 10 == 1, "SUSPENDED")
             .when(pk % 10 == 2, F.lit(None).cast("string")).otherwise("DONE").alias("status"),
        )

    @cached_property
    def detail_international(self) -> DataFrame:
        d = (self.t.lineitem.where(col("l_linenumber") % 2 == 0)
             .select("l_orderkey", "l_linenumber").distinct())
        k = col("l_orderkey")
        return d.select(
            _file_no(k).alias("file_no"),
            col("l_linenumber").alias("line_no"),
            F.when(k % 7 == 0, F.lit(" ")).when(k % 7 == 1, F.lit(None).cast("string"))
             .when(k % 2 == 0, F.concat(F.lit("NATION_"), (k % 30).cast("string")))
             .otherwise((k % 30).cast("string")).alias("country"),
        )

    @cached_property
    def country_code(self) -> DataFrame:
        n = self.t.nation
        key = col("n_nationkey")
        return n.select(
            col("n_name").alias("long_code"),
            F.when(key % 5 == 0, col("n_name")).when(key % 7 == 0, F.lit("1"))
             .otherwise(key.cast("string")).alias("short_code"),
            F.when(key == 3, F.lit(None).cast("string")).when(key == 4, F.lit(" "))
             .otherwise(F.concat(F.lit("Country "), key.cast("string"))).alias("description"),
        )

    @cached_property
    def adjudication(self) -> DataFrame:
        e = self.t.events
        return e.select(
            _file_no(col("user_id")).alias("file_no"),
            col("event_type").alias("req_status"),
            F.when(col("event_id") % 50 == 0, F.lit(None).cast(T.TimestampNTZType()))
             .otherwise(col("ts")).alias("created_at"),
        )

    @cached_property
    def client_status(self) -> DataFrame:
        n = self.t.nation
        return n.select(
            F.explode(F.array(*[F.lit(s) for s in REQUEST_STATUSES])).alias("req_status"),
            col("n_nationkey").alias("account_no"),
            col("n_name"),
        ).select(
            "req_status", "account_no",
            F.concat(F.upper("req_status"), F.lit(" / "), col("n_name")).alias("description"),
        )

    @cached_property
    def billing_note(self) -> DataFrame:
        o = self.t.orders.where(col("o_orderkey") % 3 != 0)
        k = col("o_orderkey")
        return o.select(
            _file_no(k).alias("file_no"),
            F.when(k % 4 == 0, "OTHER").when(k % 4 == 1, "empid").otherwise("EMPID").alias("code"),
            F.concat(F.lit("E"), col("o_custkey").cast("string")).alias("note_value"),
        )

    @cached_property
    def request_extra(self) -> DataFrame:
        e = self.t.events
        return e.select(
            _file_no(col("user_id")).alias("file_no"),
            F.concat(col("event_type"), col("event_id").cast("string"), F.lit("@example.com"))
             .alias("email"),
        )

    @cached_property
    def client_list(self) -> DataFrame:
        c = self.t.customer
        k = col("c_custkey")
        return c.select(
            F.when(k % 13 == 0, F.lit("")).when(k % 13 == 1, F.lit("  "))
             .when(k % 13 == 2, F.lit(None).cast("string")).otherwise(col("c_mktsegment"))
             .alias("industry"),
            F.concat(F.when(k % 17 == 0, "PSTS").when(k % 17 == 1, "test").otherwise("SITE"),
                     _pad(k, 6)).alias("site_no"),
            F.when(k % 19 == 0, 0).otherwise(1).alias("active"),
            F.concat(F.lit("GR"), _pad(col("c_nationkey"), 2), F.lit("-"), (k % 3).cast("string"))
             .alias("group_no"),
            F.concat(F.lit("CORP"), (k % 40).cast("string")).alias("corp_id"),
            F.when(k % 23 == 0, F.lit(None).cast("string")).otherwise(col("c_name"))
             .alias("company_name"),
        )


class VariantRoles(Roles):
    """The same tables with what a collation and repeated rows add: texts that
    differ only in case or trailing blanks, and dimension rows that occur
    twice."""

    @cached_property
    def client(self) -> DataFrame:
        c = Roles.client.func(self)
        c = c.withColumn("account_executive", F.when(col("client_key") % 2 == 0, F.upper("account_executive"))
                         .otherwise(col("account_executive")))
        return c.unionByName(c.where(col("client_key") % 53 == 0))

    @cached_property
    def commission_band(self) -> DataFrame:
        b = Roles.commission_band.func(self)
        return b.unionByName(b.where(col("commission_key") == 2))

    @cached_property
    def new_business_band(self) -> DataFrame:
        b = Roles.new_business_band.func(self)
        return b.unionByName(b.where(col("start_range") == 366))

    @cached_property
    def site_bucket(self) -> DataFrame:
        b = Roles.site_bucket.func(self)
        low = b.withColumn("site_number", F.when(col("yr2_rate") >= 4, F.concat(F.lower("site_number"), F.lit("  ")))
                           .otherwise(col("site_number")))
        again = low.where(col("yr2_rate") % 2 == 0).withColumn("bucket_name", F.upper("bucket_name"))
        return low.unionByName(again)

    @cached_property
    def detail_international(self) -> DataFrame:
        d = Roles.detail_international.func(self)
        again = d.where(col("file_no").endswith("7")).withColumn("country", F.concat(F.lower("country"), F.lit(" ")))
        return d.unionByName(again)

    @cached_property
    def client_list(self) -> DataFrame:
        c = Roles.client_list.func(self)
        last = F.substring("site_no", -1, 1)
        return (c.withColumn("industry", F.when(last == "3", F.lower("industry"))
                             .when(last == "4", F.concat(col("industry"), F.lit(" "))).otherwise(col("industry")))
                .withColumn("group_no", F.when(last == "5", F.lower("group_no")).otherwise(col("group_no")))
                .withColumn("corp_id", F.when(last == "6", F.concat(F.lower("corp_id"), F.lit("  ")))
                            .otherwise(col("corp_id"))))
