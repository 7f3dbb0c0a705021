"""Plan-shape guards: the rewritten operators never plan a nested-loop join or
a cartesian product, and scans read only the columns a query uses."""

import re

import pytest

from .conftest import SF_SMALL

BAD = ("BroadcastNestedLoopJoin", "CartesianProduct")


@pytest.fixture(scope="module")
def qs():
    import __spark_entry__ as e
    return e.queries()


@pytest.mark.parametrize("name", [
    "commission_mart", "file_component_extract", "file_component_extract_country",
    "file_adjudication_report", "range_band_join", "any_code_join",
    "unmatched_adjustments", "first_differing_status", "band_outer_join", "param_site",
])
def test_no_nested_loop_or_cartesian(spark, qs, name):
    df = qs[name](spark, SF_SMALL)
    df.collect()   # runs this DataFrame's own query execution: final adaptive plan
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in BAD:
        assert bad not in plan, f"{name} plans a {bad}"


def test_fact_scan_is_pruned_and_filtered(spark, qs):
    df = qs["star_join"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    line_scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "l_orderkey" in ln][0]
    read = re.search(r"FileScan parquet \[([^\]]*)\]", line_scan).group(1)
    cols = {c.split("#")[0] for c in read.split(",")}
    # only the line columns the star join uses are read
    assert cols <= {"l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
                    "l_returnflag", "l_linestatus", "l_shipdate"}
    assert "l_suppkey" not in cols and "l_tax" not in cols and "l_discount" not in cols


def test_extract_pushes_date_filter_into_scan(spark):
    from ledgerline.plans import extract, fixture
    from ledgerline.sources.roles import Roles

    df = extract.closed_requests(Roles(spark, SF_SMALL), fixture.EXTRACT)
    plan = df._jdf.queryExecution().executedPlan().toString()
    orders_scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "o_orderdate" in ln][0]
    assert "GreaterThanOrEqual(o_orderdate" in orders_scan
    assert "LessThanOrEqual(o_orde" in orders_scan  # the plan text is truncated


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def no_broadcast(spark):
    """Only the literal three-row table is small enough."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "1000", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    saved = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in saved.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _scans(plan, column):
    return sum("FileScan parquet" in ln and column in ln for ln in plan.splitlines())


def test_lines_shuffle_once_by_component_and_once_by_file(spark, no_broadcast):
    from ledgerline.plans import commission
    from ledgerline.sources.roles import Roles

    plan = _final_plan(commission.fact_grain(Roles(spark, SF_SMALL)))
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*?), \d+\)", plan)
    assert _scans(plan, "l_orderkey") == 1
    lines = [k for k in keys if re.match(r"(l_partkey|l_orderkey)#", k)]
    assert len(lines) == 2, keys
    # the grouping by (file, client, day) reuses the partitioning by file
    assert not [k for k in keys if "," in k], keys


def test_one_scan_of_each_large_table(spark, qs, no_broadcast):
    assert _scans(_final_plan(qs["commission_regular"](spark, SF_SMALL)), "l_orderkey") == 0  # groups are staged
    assert _scans(_final_plan(qs["file_component_extract"](spark, SF_SMALL)), "o_orderdate") == 0
    report = _final_plan(qs["file_adjudication_report"](spark, SF_SMALL))
    assert _scans(report, "event_type") <= 2  # adjudications once, e-mail addresses once
    months = _final_plan(qs["unmatched_adjustments"](spark, SF_SMALL))
    assert _scans(months, "l_extendedprice") == 0  # only the key columns of the lines
