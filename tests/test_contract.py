"""Driver contract: names, schemas, and a stable flagship."""

import __spark_entry__ as E
from marketstar.plans.oracle import oracle_sql
from marketstar.plans.registry import registry


def test_query_columns_unique_and_named(spark, sf_small):
    for name, fn in registry().items():
        cols = fn(spark, sf_small).columns
        assert cols and all(cols), name
        assert len(cols) == len(set(cols)), (name, cols)


def test_entry_schema_is_stable(spark):
    a = E.entry(spark).schema
    b = E.entry(spark).schema
    assert a == b


def test_oracle_keys_match_queries():
    assert sorted(registry()) == sorted(oracle_sql())
    assert all(isinstance(v, str) and v.strip() for v in E.oracle_sql().values())
    assert set(registry()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())
