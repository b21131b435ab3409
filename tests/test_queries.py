"""Every query of the catalog against its DuckDB oracle on sf0.001 (the driver
runs the same comparison at sf0.01).  Queries of an optional subpackage have
their own tests."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF0001
from tests.oracle_check import compare, duck
from ticklake.plans.catalog import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 1 and "instrument_key" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF0001)
    assert r.get("ok"), r
