"""Cases the driver tables do not reach."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketstar import session
from marketstar.functions import semantic as S
from marketstar.functions.exprs import R
from marketstar.plans import star
from marketstar.sources import landed


def test_item_counts_only_in_its_own_statement(spark):
    end = dt.date(2020, 12, 31)
    rows = [
        ("A", "income", end, "Net Income", 10.0),
        ("A", "income", end, "Total Revenue", 100.0),
        ("A", "cash", end, "Net Income", 12.0),
        ("A", "cash", end, "Total Assets", 99.0),
    ]
    long = spark.createDataFrame(rows, "ticker string, statement string, period_end date, line_item string, value double")
    got = star.statement_periods(long).first()
    assert got["net_income"] == 10.0 and got["total_assets"] is None


def test_growth_sees_rows_that_the_filter_drops(spark):
    rows = [("A", 2018, 100.0, 5.0), ("A", 2019, 200.0, -1.0), ("A", 2020, 220.0, 5.0)]
    view = spark.createDataFrame(rows, "ticker string, fiscal_year int, revenue double, net_income double")
    expr = next(m.name for m in S.EXPRESSIONS if "prev_year_revenue" in m.needs)
    got = S.run_metric(view, filters=["profitable"], expressions=[expr]).orderBy("fiscal_year").collect()
    assert [r[expr] for r in got] == [None, 10.0]


def test_measures_by_business_term(spark):
    view = spark.createDataFrame([("A", 1.0), ("A", 3.0)], "ticker string, excess_return_pct double")
    assert S.run_metric(view, dims=["ticker"], measures=["excess return"]).first()["avg_excess_return_pct"] == 2.0
    with pytest.raises(ValueError):
        S.run_metric(view, dims=["ticker"], measures=["no such thing"])


def test_rounding_never_aborts(spark):
    got = spark.range(1).select(R(F.lit(1e30), 2).alias("big"), R(F.lit(1e21), 2).alias("wide"), R(F.lit(1.005), 2).alias("tie")).first()
    assert got["big"] == pytest.approx(1e30) and got["wide"] == 1e21 and got["tie"] == 1.01


INDEX = "trade_date date, open_price double, high_price double, low_price double, close_price double, volume bigint"


def _index(spark, closes):
    return spark.createDataFrame([(d, 1.0, 2.0, 1.0, c, 10) for d, c in closes], INDEX)


def test_index_rows_of_one_day_fail_or_are_set_apart(spark):
    d = dt.date(2020, 1, 2)
    raw = _index(spark, [(d, 10.0), (d, 900.0), (dt.date(2020, 1, 3), 11.0), (dt.date(2019, 12, 31), 10.0)])
    with pytest.raises(Exception, match="index has 2 rows of day 2020-01-02"):
        star.benchmark(raw).collect()
    got = star.benchmark(raw, on_duplicate="quarantine").orderBy("trade_date").collect()
    assert [(r["close_price"], round(r["daily_return_pct"], 6)) for r in got] == [(10.0, 0.0), (11.0, 10.0)]
    assert [tuple(r) for r in star.duplicate_days(raw).collect()] == [(d, 2, 10.0, 900.0)]
    with pytest.raises(ValueError):
        star.benchmark(raw, on_duplicate="pick one")


@pytest.mark.parametrize("pad", [False, True])
def test_returns_across_years_equal_one_window(spark, pad):
    from marketstar.functions.exprs import with_calendar_change, with_period_change

    days = [dt.date(2018, 12, 28), dt.date(2018, 12, 31), dt.date(2019, 6, 3), dt.date(2021, 1, 4), dt.date(2021, 1, 5), dt.date(2022, 3, 1), dt.date(2023, 3, 1)]
    raw = _index(spark, list(zip(days, [None, 10.0, None, None, 12.0, 0.0, 5.0])))
    ranged = with_calendar_change(raw, "close_price", "r", "trade_date", pad=pad, fill_first=0.0)
    whole = with_period_change(raw, "close_price", "r", [], ["trade_date"], pad=pad, fill_first=0.0)
    assert sorted(map(tuple, ranged.collect())) == sorted(map(tuple, whole.collect()))
    assert [r["r"] for r in ranged.orderBy("trade_date").collect()] == pytest.approx([0, 0, 0, 0, 20, -100, 0] if pad else [0, 0, 0, 0, 0, -100, 0])


def test_rounding_looks_at_the_value_as_written(spark):
    values = [(0.123449999996, 4, 0.1234), (0.12345, 4, 0.1235), (2.675, 2, 2.68), (-2.675, 2, -2.68), (1e-9, 2, 0.0), (0.1 + 0.2, 2, 0.3)]
    got = spark.range(1).select(*[R(F.lit(x), n).alias(f"c{i}") for i, (x, n, _) in enumerate(values)]).first()
    assert list(got) == [want for _, _, want in values]


def test_shared_folder_fails_closed():
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf(values)

    for values in ({}, {"spark.master": "spark://host:7077"}, {"spark.master": "local-cluster[2,1,1024]"}):
        with pytest.raises(RuntimeError):
            session.shared_dir(Session(**values))
    assert session.shared_dir(Session(**{"spark.checkpoint.dir": "/shared/x/"})) == "/shared/x"


def test_panel_fails_on_a_year_without_a_column(spark):
    class Source:
        orders = spark.createDataFrame([(1, "1-URGENT", dt.date(1995, 5, 1), 1000.0), (1, "1-URGENT", dt.date(2004, 5, 1), 2000.0)], "o_custkey bigint, o_orderpriority string, o_orderdate date, o_totalprice double")
        customer = spark.createDataFrame([(1, 1)], "c_custkey bigint, c_nationkey int")
        nation = spark.createDataFrame([(1, "N")], "n_nationkey int, n_name string")

    assert landed.raw_indicator_panel(Source, tuple(range(2015, 2025))).first()["2024"] == "2.000"
    with pytest.raises(Exception, match="no column for year 2024"):
        landed.raw_indicator_panel(Source).collect()
