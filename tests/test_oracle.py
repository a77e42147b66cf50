"""Every registered query agrees with its DuckDB oracle (rows, columns, values)."""

import pytest

import __spark_entry__ as E
from compare import compare, duck
from marketstar.plans.oracle import oracle_sql
from marketstar.plans.registry import registry

NAMES = sorted(registry())


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_query_has_an_oracle():
    assert set(registry()) == set(oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_small, con, name):
    r = compare(E.queries()[name](spark, sf_small), con, E.oracle_sql()[name])
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["sector", "avg_sector_return", "avg_sp500_return", "avg_excess_return", "stocks"]
    assert df.count() == 5
