"""Warehouse sources: contracts, stored limits, positional insert, key columns
that reach the scan, the bucketed layout, list relations, concurrent publish."""

import datetime as dt
import os
import re
import threading

import pytest
from pyspark.sql import functions as F

from ledgerline import jobs
from ledgerline.plans import adjudication, commission, extract, fixture
from ledgerline.sources import contracts, sinks, warehouse
from ledgerline.sources.contracts import ContractError, contract, insert_select
from ledgerline.sources.roles import Roles

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def plain(spark, tmp_path_factory):
    """A warehouse as others write it: other column order and case, more
    columns, narrower numbers, one table with the file suffix."""
    folder, r = str(tmp_path_factory.mktemp("plain")), Roles(spark, SF_SMALL)
    for name in warehouse.CONTRACTS:
        df = getattr(r, name)
        df = df.select(*[F.col(c).alias(c.upper() if i % 2 else c) for i, c in enumerate(reversed(df.columns))],
                       F.lit("x").alias("loaded_by"))
        if name == "client":
            df = df.withColumn("CLIENT_KEY" if "CLIENT_KEY" in df.columns else "client_key", F.col("client_key").cast("int"))
        df.write.parquet(os.path.join(folder, name + (".parquet" if name == "file_fees" else "")))
    return folder


@pytest.fixture(scope="module")
def laid(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("laid"))
    return warehouse.load(Roles(spark, SF_SMALL), folder, buckets=4)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def same(a, b):
    assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


# ------------------------------------------------------------ sources

def test_jobs_on_real_tables(spark, plain, tmp_path):
    want = jobs.run_commission(spark, SF_SMALL, str(tmp_path / "a"), fixture.COMMISSION)
    got = jobs.run_commission(spark, plain, str(tmp_path / "b"), fixture.COMMISSION, source="warehouse")
    assert got == want and want["destinationfinalrowcount"] > 0
    same(sinks.read_current(spark, str(tmp_path / "a")), sinks.read_current(spark, str(tmp_path / "b")))
    rows = jobs.run_extracts(spark, plain, str(tmp_path / "c"), fixture.EXTRACT, fixture.COUNTRY_EXTRACT, "warehouse")
    assert rows == jobs.run_extracts(spark, SF_SMALL, str(tmp_path / "d"), fixture.EXTRACT, fixture.COUNTRY_EXTRACT)
    report = jobs.run_report_dataset(spark, plain, str(tmp_path / "e"), fixture.REPORT, fixture.PARAMS, "warehouse")
    assert report == jobs.run_report_dataset(spark, SF_SMALL, str(tmp_path / "f"), fixture.REPORT, fixture.PARAMS)
    assert jobs.run_check(spark, plain, str(tmp_path / "g")) == {"null_violations": 0, "long_values": 0}


def test_a_table_that_does_not_fit_is_reported_whole(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1.5, 2)], "file_key string, b string, IS_DELETE double, other int")
    df.write.parquet(str(tmp_path / "file"))
    with pytest.raises(ContractError, match=r"file: file_key: string where bigint is due; is_delete: double where int is due"):
        warehouse.Warehouse(spark, str(tmp_path)).file
    df.select("b").write.parquet(str(tmp_path / "file_fees"))
    with pytest.raises(ContractError, match="file_key: missing; miscellaneous_fees: missing"):
        warehouse.Warehouse(spark, str(tmp_path)).file_fees
    with pytest.raises(FileNotFoundError, match="table client: nothing at .*client or .*client.parquet"):
        warehouse.Warehouse(spark, str(tmp_path)).client
    with pytest.raises(AttributeError):
        warehouse.Warehouse(spark, str(tmp_path)).no_such_table


def test_narrower_types_are_widened_wider_ones_refused(spark):
    schema = contract("a bigint, b decimal(18,2), c string, d double, e decimal(18,2)")
    ok = spark.createDataFrame([], "a smallint, b decimal(10,2), c string, d float, e int")
    assert [f.dataType.simpleString() for f in contracts.conform(ok, "t", schema).schema] == [
        "bigint", "decimal(18,2)", "string", "double", "decimal(18,2)"]
    for bad in ("a decimal(10,0)", "a string", "b decimal(18,4)", "e bigint", "d decimal(4,2)", "c int"):
        with pytest.raises(ContractError):
            contracts.conform(spark.createDataFrame([], bad), "t", contract(
                next(f"{f.name} {f.dataType.simpleString()}" for f in schema if f.name == bad[0])))
    twice = spark.createDataFrame([(1, 2)], "a int, b int").toDF("a", "A")
    with pytest.raises(ContractError, match="several columns"):
        contracts.conform(twice, "t", contract("a bigint"))


def test_violations_are_counted(spark):
    schema = contract("k int not null, t varchar(3) not null, u varchar(2)")
    df = spark.createDataFrame([(1, "abcd", "x"), (None, None, "abc"), (2, "abc", None)], "k int, t string, u string")
    assert tuple(contracts.violations(contracts.conform(df, "t", schema), "t").first()) == ("t", 3, 2, 2)


# ------------------------------------------------------------ limits and insert

def test_limits_stay_with_a_stored_table(spark, tmp_path):
    schema = contract("k int not null, t varchar(3)")
    df = contracts.with_limits(spark.createDataFrame([(1, "abc"), (2, None)], "k int, t string"), schema)
    back = sinks.stage_table(df, str(tmp_path / "t"))
    assert contracts.limits(back) == {"k": {"not_null": True}, "t": {"max_length": 3}}
    again = spark.read.parquet(str(tmp_path / "t"))            # also for a reader that knows nothing of it
    assert contracts.limits(again) == contracts.limits(back)
    for broken, message in (((3, "abcd"), "value too long for t"), ((None, "a"), "NULL into NOT NULL column k")):
        more = again.unionByName(spark.createDataFrame([broken], "k int, t string"))
        with pytest.raises(Exception, match=message):
            sinks.replace_load(more.withColumn("_staged", F.lit(1)), str(tmp_path / "target"))
    assert not [n for n in os.listdir(tmp_path / "target") if n.startswith(("v-", "_"))]  # nothing of it stays


def test_the_report_table_keeps_its_limits(spark, tmp_path):
    staged = commission.commission_staged(Roles(spark, SF_SMALL), fixture.COMMISSION)
    assert contracts.limits(staged)["commission_type"] == {"max_length": 55, "not_null": True}
    loaded = commission.commission_load(sinks.stage_table(staged, str(tmp_path / "s")), fixture.COMMISSION)
    sinks.replace_load(loaded.withColumn("_staged", F.lit(1)), str(tmp_path / "target"))
    assert contracts.limits(sinks.read_current(spark, str(tmp_path / "target"))) == {
        "company_name": {"max_length": 255}, "site_number": {"max_length": 50}, "amount_payable_percentage": {"max_length": 31},
        "commission_type": {"max_length": 55}, "account_executive": {"max_length": 61},
        "account_aging_in_days": {"max_length": 55}}


def test_insert_maps_by_position(spark):
    schema = contract(commission.STAGED)
    values = spark.createDataFrame([("7", "n", 1.239)], "z string, y string, x double")
    row = insert_select(values, schema, ["client_key", "Company_Name", "miscellaneous_fee"]).first()
    assert (row.client_key, row.company_name, str(row.miscellaneous_fee), row.site_number) == (7, "n", "1.24", None)
    assert list(row.asDict()) == schema.names
    sixteen = schema.names[:16]
    seventeen = spark.range(1).select(*[F.lit(None).cast("string").alias(f"v{i}") for i in range(17)])
    with pytest.raises(ContractError, match="17 values for 16 columns"):
        insert_select(seventeen, schema, sixteen)
    assert insert_select(seventeen.drop("v16"), schema, sixteen).count() == 1
    with pytest.raises(ContractError, match="unknown columns"):
        insert_select(values, schema, ["client_key", "nothing", "fees_amount"])
    with pytest.raises(ContractError, match="repeated"):
        insert_select(values, schema, ["client_key", "CLIENT_KEY", "fees_amount"])
    with pytest.raises(ContractError, match="20 columns"):
        insert_select(values, schema)
    with pytest.raises(ContractError, match="not in the contract"):
        commission.to_contract(spark.range(1).select(F.lit(1).alias("client_key"), F.lit(2).alias("yr5_rate")))


# ------------------------------------------------------------ layout

def scans(plan, column):
    return [line for line in plan.splitlines() if "FileScan parquet" in line and column in line]


def test_text_filters_reach_the_scan(spark, laid):
    df = extract.closed_requests(laid, fixture.EXTRACT)
    same(df.select(*Roles(spark, SF_SMALL).request.columns), extract.closed_requests(Roles(spark, SF_SMALL), fixture.EXTRACT))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # plan text is cut otherwise
    try:
        scan = scans(plan_of(extract.closed_requests(laid, fixture.EXTRACT)), "status__ci")[0]
        detail = scans(plan_of(extract.live_detail(laid)), "status__ci")[0]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = scan[scan.index("PushedFilters"):]
    assert "EqualTo(status__ci,CLOSED)" in pushed and "StringStartsWith(site_no__ci," in pushed
    assert "Not(EqualTo(status__ci,NOTREQ))" in detail


def test_a_prefix_with_a_trailing_blank_is_not_read_off_the_key(spark):
    df = spark.createDataFrame([("AB ",), ("AB",), ("ABC",)], "t string").withColumn("t__ci", F.upper(F.rtrim("t")))
    from ledgerline.functions.semantics import key_starts

    assert [r.t for r in df.where(key_starts(df, "t", "ab ")).collect()] == ["AB "]
    assert df.where(key_starts(df, "t", "ab")).count() == 3


def line_shuffles(plan):
    """Exchanges that billed lines pass."""
    return len(re.findall(r"Exchange hashpartitioning\(file_key", plan))


def test_bucketed_tables_are_read_in_place(spark, laid, tmp_path):
    flat = warehouse.load(Roles(spark, SF_SMALL), str(tmp_path / "flat"), ("file", "billed_line", "file_fees", "component", "usage_type"))
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100KB")  # lines and files are beyond it, dimensions are not
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        assert laid._layout["billed_line"] == 4
        bucketed, plain = (commission.fact_grain(w, str(tmp_path / n)) for w, n in ((laid, "x"), (flat, "y")))
        a, b = plan_of(bucketed), plan_of(plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in a and "Bucketed: true" not in b
    assert line_shuffles(a) < line_shuffles(b)
    same(bucketed, plain)
    again = warehouse.Warehouse(spark, laid.folder)           # another session finds the layout in the folder
    same(again.file, laid.file)


def test_a_laid_out_folder_feeds_the_jobs(spark, laid, tmp_path):
    got = jobs.run_report_dataset(spark, laid.folder, str(tmp_path / "a"), fixture.REPORT, fixture.PARAMS, "warehouse")
    assert got == jobs.run_report_dataset(spark, SF_SMALL, str(tmp_path / "b"), fixture.REPORT, fixture.PARAMS)
    rows = extract.lookup_rows(laid.request, "file_no", "AF00000001")
    assert rows.columns == Roles(spark, SF_SMALL).request.columns
    counted = jobs.run_load(spark, SF_SMALL, str(tmp_path / "c"), "fixture")
    assert set(counted) == set(warehouse.CONTRACTS) and counted["billed_line"] > 0


def test_a_load_refuses_what_breaks_a_contract(spark, tmp_path):
    class Source:
        file = spark.createDataFrame([(1, 0), (None, 0)], "file_key long, is_delete int")
    Source.spark = spark
    with pytest.raises(Exception, match="NULL into NOT NULL column file_key"):
        warehouse.load(Source, str(tmp_path / "w"), ["file"])


# ------------------------------------------------------------ list relations

def test_a_long_list_is_a_relation(spark, tmp_path):
    r = Roles(spark, SF_SMALL)
    sites = [x.site_no for x in r.request.select("site_no").distinct().collect()]
    chosen = [s.lower() + "  " for s in sites[:5]]
    (tmp_path / "sites.txt").write_text("\n".join([*chosen, *chosen, *(f"NONE{i}" for i in range(100_000))]))
    import dataclasses

    wide = dataclasses.replace(fixture.REPORT, sites=spark.read.text(str(tmp_path / "sites.txt")), batches=None)
    few = dataclasses.replace(fixture.REPORT, sites=tuple(chosen), batches=None)
    a, b = adjudication.report_files(r, wide), adjudication.report_files(r, few)
    assert not a.isEmpty()
    same(a, b)
    plan = a._jdf.queryExecution().analyzed().toString()
    assert len(plan) < 20_000 and "LeftSemi" in plan
    none = dataclasses.replace(fixture.REPORT, sites=spark.createDataFrame([(None,)], "s string"), batches=None)
    assert adjudication.report_files(r, none).isEmpty()


# ------------------------------------------------------------ publishing

def test_loads_at_once_get_numbers_of_their_own(spark, tmp_path):
    target, failed = str(tmp_path), []
    start = threading.Barrier(4)

    def publish(n):
        try:
            start.wait()
            sinks.replace_load(spark.range(n), target, keep=10)
        except Exception as e:  # noqa: BLE001
            failed.append(repr(e)[:300])

    threads = [threading.Thread(target=publish, args=(n,)) for n in (1, 2, 3, 4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    pointers = sinks._pointers(spark, target)
    assert not failed and len(pointers) == 4 and len({p.split("-")[1] for p in pointers}) == 4
    assert all(os.path.isdir(tmp_path / sinks._version(p)) for p in pointers)
    newest = sinks.replace_load(spark.range(9), target, keep=2)
    assert sinks.read_current(spark, target).count() == 9
    assert sorted(n for n in os.listdir(target) if n.startswith("v-")) == sorted(
        sinks._version(p) for p in sinks._pointers(spark, target))
    assert os.path.basename(newest) == sinks._version(sinks._pointers(spark, target)[-1])
    assert not [n for n in os.listdir(target) if n.startswith(sinks._LOADING)]


def test_a_number_is_claimed_once(spark, tmp_path):
    first = sinks._claim_number(spark, str(tmp_path))
    assert (first, sinks._claim_number(spark, str(tmp_path))) == (1, 2)
    assert not sinks._create_once(spark, str(tmp_path / "_CLAIM-000000000001"))


def test_versions_that_nobody_will_publish_are_collected(spark, tmp_path):
    target = str(tmp_path)
    sinks.replace_load(spark.range(3), target)
    spark.range(5).write.parquet(os.path.join(target, "v-dead"))           # died after its mark was gone
    spark.range(5).write.parquet(os.path.join(target, "v-running"))        # another load at work
    (tmp_path / "_LOADING-v-running").touch()
    spark.range(5).write.parquet(os.path.join(target, "v-old"))            # died long ago
    (tmp_path / "_LOADING-v-old").touch()
    long_ago = dt.datetime(2020, 1, 1).timestamp()
    os.utime(tmp_path / "_LOADING-v-old", (long_ago, long_ago))
    sinks.replace_load(spark.range(4), target)
    left = set(os.listdir(target))
    assert "v-running" in left and "_LOADING-v-running" in left
    assert not left & {"v-dead", "v-old", "_LOADING-v-old"}
    with pytest.raises(Exception, match="boom"):
        sinks.replace_load(spark.range(2).select(F.raise_error(F.lit("boom")).alias("x")), target)
    assert set(os.listdir(target)) - {n for n in left} <= set()
    assert sinks.read_current(spark, target).count() == 4
