"""The report jobs' tables as a warehouse delivers them: real tables behind the
names that the plans use, held to declared contracts, and a load that lays them
out for the jobs.

A warehouse folder holds one parquet table for each name of ``CONTRACTS``, as
``<name>`` or ``<name>.parquet``. ``load`` writes such a folder from any source with the same names:
limits are enforced, texts that filters compare get a key column in the
comparison's normal form (so that the filters reach the scan), and the tables
joined by file are bucketed by file key (so that their joins and groupings read
them in place). ``Warehouse`` reads both laid-out and plain folders.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterable
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerline.functions.semantics import KEY_SUFFIX, ci_norm
from ledgerline.session import sized_shuffles
from ledgerline.sources.contracts import conform, contract, enforced, violations

# The columns that the reports read, their types and limits.
CONTRACTS = {
    "usage_type": "usage_type_key int not null, usage_type_name varchar(50)",
    "commission_band": "commission_key int not null, account_age_min int, account_age_max int, "
                       "account_pay_percent decimal(5,2), is_delete int",
    "new_business_band": "start_range int, end_range int",
    "file": "file_key bigint not null, is_delete int",
    "component": "component_key bigint not null, charge_as_fee int",
    "client": "client_key bigint not null, company_name1 varchar(255), commission_type varchar(55), "
              "commission_percent decimal(5,2), account_executive varchar(61), account_executive_id int, "
              "business_start_date date, site_number varchar(50)",
    "billed_line": "file_key bigint not null, client_key bigint not null, component_key bigint not null, usage_type_key int, "
                   "quantity decimal(18,2), unit_price decimal(18,2), billing_date date, billing_date_key int not null, "
                   "is_delete int, is_billed int",
    "file_fees": "file_key bigint not null, miscellaneous_fees decimal(18,2), background_fees decimal(18,2)",
    "invoice_adjustment": "client_key bigint not null, account_executive_id int, adjustment_month varchar(2), "
                          "adjustment_year varchar(4), adjustment_amount decimal(18,2), bad_debt_amount decimal(18,2), "
                          "amount decimal(18,2), fee decimal(18,2)",
    "site_bucket": "site_number varchar(50) not null, bucket_month int, bucket_name varchar(55), yr1_rate decimal(4,2), "
                   "yr2_rate decimal(4,2), yr3_rate decimal(4,2), perpetual_rate decimal(4,2)",
    "request": "file_no string not null, site_no string, batch_no string, first_name string, last_name string, "
               "date_requested date, date_completed timestamp_ntz, requester string, status string, package string, "
               "trouble_flag int, client_req_status string, account_no int",
    "request_detail": "file_no string not null, line_no int, unit_price decimal(18,2), date_completed timestamp_ntz, "
                      "report_desc string, report_type string, type_code string, status string",
    "detail_international": "file_no string not null, line_no int, country string",
    "country_code": "long_code string, short_code string, description string",
    "adjudication": "file_no string not null, req_status string, created_at timestamp_ntz",
    "client_status": "req_status string, account_no int, description string",
    "billing_note": "file_no string not null, code string, note_value string",
    "request_extra": "file_no string not null, email string",
    "client_list": "industry string, site_no string, active int, group_no string, corp_id string, company_name string",
}
# texts that report filters compare
TEXT_KEYS = {
    "client": ("commission_type",), "request": ("status", "site_no", "batch_no"), "request_detail": ("status",),
    "billing_note": ("code",), "client_list": ("site_no", "industry", "group_no", "corp_id"),
}
# tables joined by file
BUCKET_KEYS = {
    "file": "file_key", "billed_line": "file_key", "file_fees": "file_key", "request": "file_no",
    "request_detail": "file_no", "detail_international": "file_no", "adjudication": "file_no",
    "billing_note": "file_no", "request_extra": "file_no",
}
LAYOUT = "_layout"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a plain folder; the error of a missing one names both places."""
    tried = [os.path.join(folder, name), os.path.join(folder, f"{name}.parquet")]
    for path in tried:
        try:
            return spark.read.parquet(path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
                raise
    raise FileNotFoundError(f"table {name}: nothing at {' or '.join(tried)}")


class Warehouse:
    """The role tables of a warehouse folder, each held to its contract when it
    is first used. Same names as ``roles.Roles``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}

    @cached_property
    def _layout(self) -> dict[str, int]:
        """Table -> number of buckets, as written by ``load`` (at most a row for each table)."""
        try:
            rows = self.spark.read.json(os.path.join(self.folder, LAYOUT), schema="name string, buckets int").collect()
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
                raise
            return {}
        return {r["name"]: r["buckets"] for r in rows}

    def _bucketed(self, name: str, buckets: int) -> DataFrame:
        """The bucketed files as a catalog table of this session (external: the
        catalog holds no data, and a table left there does no harm)."""
        path = os.path.join(self.folder, name)
        table = f"ledgerline_{name}_{zlib.crc32(os.path.abspath(path).encode()):08x}_{buckets}"
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(path).schema.fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet CLUSTERED BY ({BUCKET_KEYS[name]}) "
                       f"INTO {buckets} BUCKETS LOCATION '{path}'")
        return self.spark.table(table)

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            buckets = self._layout.get(name, 0)
            df = self._bucketed(name, buckets) if buckets else read_table(self.spark, self.folder, name)
            schema = contract(CONTRACTS[name])
            for c in TEXT_KEYS.get(name, ()):
                if c + KEY_SUFFIX in df.columns:
                    schema = T.StructType([*schema.fields, T.StructField(c + KEY_SUFFIX, T.StringType())])
            self._tables[name] = conform(df, name, schema)
        return self._tables[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in CONTRACTS:
            return self.table(name)
        raise AttributeError(name)

    @cached_property
    def billed_component(self) -> DataFrame:
        """Billed lines with their component's columns."""
        return self.table("billed_line").join(self.table("component"), "component_key")


def load(source, folder: str, names: Iterable[str] = tuple(CONTRACTS), buckets: int = 0) -> Warehouse:
    """Write tables of ``source`` (``Roles`` or ``Warehouse``) to a new warehouse
    folder: contract columns with enforced limits, key columns, and, with
    ``buckets``, the tables joined by file bucketed and sorted by their file key.
    Size ``buckets`` as one sizes shuffle partitions."""
    spark, laid = source.spark, []
    for name in names:
        df = enforced(conform(getattr(source, name), name, contract(CONTRACTS[name])))
        df = df.select("*", *[ci_norm(c).alias(c + KEY_SUFFIX) for c in TEXT_KEYS.get(name, ())])
        path = os.path.join(folder, name)
        if buckets and name in BUCKET_KEYS:
            key, table = BUCKET_KEYS[name], f"ledgerline_load_{uuid.uuid4().hex}"
            with sized_shuffles(df):
                (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet")
                 .option("path", path).saveAsTable(table))
            spark.sql(f"DROP TABLE {table}")  # external: the files stay
            laid.append((name, buckets))
        else:
            with sized_shuffles(df):
                df.write.parquet(path)
    if laid:
        spark.createDataFrame(laid, "name string, buckets int").coalesce(1).write.json(os.path.join(folder, LAYOUT))
    return Warehouse(spark, folder)


def source_violations(source, names: Iterable[str] = tuple(CONTRACTS), stricter: dict[str, str] | None = None) -> DataFrame:
    """(table_name, n_rows, null_violations, long_values) of every table: what a
    load would refuse, from one pass over each table. ``stricter`` names tables
    with another contract."""
    ddl = {**CONTRACTS, **(stricter or {})}
    rows = [violations(conform(getattr(source, n), n, contract(ddl[n])), n) for n in names]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
