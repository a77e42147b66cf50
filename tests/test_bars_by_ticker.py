"""Staged bars: one exchange of the line items, buckets that follow their number, a hot supplier spread first."""

import datetime as dt
from collections import Counter

from marketstar.plans.catalog import bucket_count
from marketstar.session import scratch_path
from marketstar.sources import landed
from marketstar.sources.tables import TableSource

SCHEMA = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz"


def _source(spark):
    day = dt.datetime(1997, 3, 1)
    lines = [(i, i % 7, i % 11, 5 if i % 2 else i % 40, float(i % 9), 100.0 + i, day + dt.timedelta(days=i % 30)) for i in range(600)]
    lines += lines[:50] + [(9_000, 1, 1, None, 1.0, 1.0, day), (9_001, 1, 1, 3, 1.0, 1.0, None), (9_002, 1, 1, 3, None, 1.0, day)]
    root = scratch_path(spark, "bars_by_ticker")
    spark.createDataFrame(lines, SCHEMA).write.parquet(f"{root}/lineitem.parquet")
    return TableSource(spark, root)


def test_bars_by_ticker_are_the_daily_bars(spark):
    src = _source(spark)
    want = Counter(map(tuple, landed.daily_bars(src).collect()))
    columns = landed.daily_bars(src).columns
    for most_lines in (100, 10_000):  # a hot supplier, and none
        got = landed.daily_bars_by_ticker(src, 4, most_lines)
        assert got.columns == columns
        assert Counter(map(tuple, got.collect())) == want


def test_line_items_are_exchanged_once(spark):
    plan = landed.daily_bars_by_ticker(_source(spark), 4, 10_000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_rows_of_a_bucket_do_not_grow_with_the_data():
    for rows in (8_000_000, 36_000_000, 216_000_000, 3_000_000_000):
        assert rows / bucket_count(rows) <= 1_000_000
