"""Every registered query with a SQL twin matches DuckDB (at sf0.001)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from oracle_compare import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
from tidecast.plans import catalog  # noqa: E402

NAMES = sorted(catalog.ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, con, name):
    r = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF, con)
    assert r["ok"], r


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["unique_id", "step", "ds", "yhat"]
    assert df.count() == 30
