"""Every registered query against its DuckDB oracle on sf0.001 (row count,
column names, order-insensitive value hash), plus the driver smoke entry."""

import pytest

from ledgerline.plans.registry import queries
from oracle.compare import digest, duck
from oracle.registry import oracle_sql

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def contract():
    return queries(), oracle_sql()


def test_every_query_has_an_oracle(contract):
    qs, ors = contract
    assert set(qs) == set(ors)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0
    assert "commission_to_be_paid" in df.columns


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, contract, name):
    qs, ors = contract
    sdf = qs[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck(SF_SMALL).execute(ors[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert digest(sdf.columns, srows) == digest(ocols, orows)


def test_the_entry_point_holds_every_query():
    import __spark_entry__ as e

    assert set(queries()) <= set(e.queries()) and set(oracle_sql()) <= set(e.oracle_sql())
    assert set(e.oracle_sql()) <= set(e.queries())
