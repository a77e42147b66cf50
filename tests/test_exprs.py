"""Edge fixtures for column helpers and series operators (hand-computed)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketstar.functions.exprs import R, falsy_or, payout_percent, projection_flag, safe_pct, with_period_change
from marketstar.plans import star as K


def _days(n):
    return [dt.date(2000, 1, 3) + dt.timedelta(days=i) for i in range(n)]


def _returns(spark, closes, pad):
    rows = [("T", d, 1.0, 1.0, 1.0, c, 1) for d, c in zip(_days(len(closes)), closes)]
    raw = spark.createDataFrame(
        rows, "ticker string, trade_date date, open_price double, high_price double, low_price double, close_price double, volume bigint"
    )
    out = K.stock_prices(raw, pad=pad).orderBy("trade_date").collect()
    return [r.daily_return_pct for r in out]


def test_e1_returns_without_padding(spark):
    got = _returns(spark, [10.0, 11.0, None, 12.0, 0.0, 6.0], pad=False)
    assert got == pytest.approx([0, 10, 0, 0, -100, 0])


def test_e2_returns_with_padding(spark):
    got = _returns(spark, [10.0, 11.0, None, 12.0, 0.0, 6.0], pad=True)
    assert got == pytest.approx([0, 10, 0, 100 / 11, -100, 0])


def _growth(spark, values, pad, col="revenue"):
    rows = [("T", dt.date(2000 + i, 12, 31), v, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "ticker string, period_end date, revenue double, net_income double")
    out = K.with_growth(df, pad=pad).orderBy("period_end").collect()
    return [r[f"{col}_growth_pct"] for r in out]


def test_e3_growth_padded(spark):
    assert _growth(spark, [1.0, None, 2.0, -1.0], pad=True) == [None, 0.0, 100.0, -150.0]


def test_e4_growth_unpadded(spark):
    assert _growth(spark, [1.0, None, 2.0, -1.0], pad=False) == [None, None, None, -150.0]


def test_e5_negative_base_keeps_sign(spark):
    assert _growth(spark, [-4.0, -2.0], pad=False, col="net_income") == [None, -50.0]


def test_e6_falsy_fallback(spark):
    df = spark.createDataFrame([(0.0, 5.0), (0.0, None), (None, 3.0), (7.0, 1.0)], "a double, b double")
    got = [r[0] for r in df.select(falsy_or("a", "b")).collect()]
    assert got == [5.0, None, 3.0, 7.0]


def test_e8_payout_rescale(spark):
    df = spark.createDataFrame([(0.35,), (5.0,), (5.01,), (-0.2,), (None,)], "p double")
    got = [r[0] for r in df.select(payout_percent(F.coalesce("p", F.lit(0.0)))).collect()]
    assert got == [35.0, 500.0, 5.01, -20.0, 0.0]


def test_e11_projection_flag(spark):
    df = spark.createDataFrame([(2023, "2023"), (2024, "2023"), (2030, None), (2024, "x")], "y int, s string")
    got = [r[0] for r in df.select(projection_flag("y", "s")).collect()]
    assert got == ["N", "Y", "N", "N"]


def test_e16_safe_pct(spark):
    df = spark.createDataFrame([(1.0, 3.0), (1.0, 0.0), (None, 2.0)], "n double, d double")
    assert [r[0] for r in df.select(safe_pct("n", "d")).collect()] == [33.33, None, None]


def test_e23_half_up_rounding(spark):
    df = spark.createDataFrame([(1.005,), (0.125,), (-1.005,)], "x double")
    assert [r[0] for r in df.select(R("x", 2)).collect()] == [1.01, 0.13, -1.01]


def test_period_change_zero_base_is_null(spark):
    df = spark.createDataFrame([("T", 1, 0.0), ("T", 2, 5.0)], "k string, o int, v double")
    out = with_period_change(df, "v", "chg", ["k"], ["o"]).orderBy("o").collect()
    assert [r.chg for r in out] == [None, None]
