"""Named metric registry and run_metric."""

import pytest

from marketstar.functions import semantic as S
from marketstar.plans import views as V
from marketstar.plans.star import star_from_driver


def test_synonyms():
    assert S.resolve("Sales") == "revenue"
    assert S.resolve("ROE") == "return_on_equity_pct"
    assert S.resolve("unknown_col") == "unknown_col"


def test_registry_kinds():
    assert len([m for m in S.REGISTRY.values() if m.kind == "expr"]) == 14
    assert len([m for m in S.REGISTRY.values() if m.kind == "measure"]) == 2
    assert len([m for m in S.REGISTRY.values() if m.kind == "filter"]) == 13
    with pytest.raises(KeyError):
        S.get("large cap", "measure")


def test_run_metric_validates_columns(spark, sf_small):
    star = star_from_driver(spark, sf_small)
    with pytest.raises(ValueError):
        S.run_metric(V.stock_performance(star), ["sector"], ["avg_excess_return"])


def test_run_metric_groups(spark, sf_small):
    star = star_from_driver(spark, sf_small)
    out = S.run_metric(V.stock_performance(star), ["sector"], ["avg_daily_volume"], ["small cap"])
    assert out.columns == ["sector", "avg_daily_volume"]
    assert out.count() >= 1


def test_filter_counts_keep_zero_matches(spark, sf_small):
    star = star_from_driver(spark, sf_small)
    got = {r.filter_name: r.matched_rows for r in S.filter_counts(V.company_fundamentals(star), ["high beta", "low beta"]).collect()}
    assert got["high beta"] == 0 and got["low beta"] > 0


def test_present_rounds_doubles(spark):
    df = spark.createDataFrame([(1.005, "x", 3)], "a double, b string, c int")
    assert tuple(S.present(df).first()) == (1.01, "x", 3)
