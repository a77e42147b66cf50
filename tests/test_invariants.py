"""Invariants of the derived tables on the driver data."""

import pytest
from pyspark.sql import functions as F

from marketstar.plans import views as V
from marketstar.plans.star import star_from_driver


@pytest.fixture(scope="module")
def star(spark, sf_small):
    return star_from_driver(spark, sf_small)


GRAINS = {
    "dim_companies": ["ticker"],
    "dim_sectors": ["sector_name"],
    "fact_stock_prices": ["ticker", "trade_date"],
    "fact_sp500_benchmark": ["trade_date"],
    "fact_financials": ["ticker", "fiscal_year"],
    "fact_economic_indicators": ["country", "indicator_code", "year"],
}


@pytest.mark.parametrize("table", sorted(GRAINS))
def test_unique_keys(star, table):
    df = star.tables()[table]
    assert df.count() == df.select(*GRAINS[table]).distinct().count()


@pytest.mark.parametrize("table", sorted(GRAINS))
def test_no_nan(star, table):
    df = star.tables()[table]
    doubles = [f.name for f in df.schema if f.dataType.typeName() == "double"]
    if doubles:
        (row,) = df.select(*[F.sum(F.isnan(c).cast("int")).alias(c) for c in doubles]).collect()
        assert all((v or 0) == 0 for v in row)


def test_view_cardinalities(star):
    prices, comps = star.fact_stock_prices, star.dim_companies
    assert V.stock_performance(star).count() == prices.join(comps, "ticker").count()
    assert V.company_fundamentals(star).count() >= comps.count()


def test_unpivot_count_equals_valid_cells(star):
    wide = star.raw["raw_panel"]
    years = [c for c in wide.columns if c.isdigit()]
    cells = wide.select(F.explode(F.array(*[F.col(f"`{y}`") for y in years])).alias("v"))
    valid = cells.where(
        F.col("v").isNotNull() & ~F.col("v").isin("n/a", "--")
        & F.translate("v", ",", "").try_cast("double").isNotNull()
    ).count()
    assert valid == star.fact_economic_indicators.count()


def test_expected_driver_counts(star):
    # Row counts stated for sf0.001 in FIXTURES.md §3.
    assert star.dim_companies.count() == 10
    assert star.fact_stock_prices.count() == 5334
    assert star.fact_sp500_benchmark.count() == 2289
    assert star.fact_financials.count() == 70
    assert star.fact_economic_indicators.count() == 542


def test_filter_hits_match_fixture_counts(spark):
    """Hit counts stated in FIXTURES.md §3 for sf0.01 (filings / companies)."""
    import __spark_entry__ as E

    got = {r.filter_name: (r.matched_rows, r.matched_keys)
           for r in E.queries()["m_filters"](spark, "/root/testdata/sf0.01").collect()}
    filings = {"profitable": 184, "high growth": 101, "high ROE": 168, "highly leveraged": 420}
    companies = {"large cap": 44, "mid cap": 38, "small cap": 18, "dividend payer": 58,
                 "high yield": 21, "low beta": 34, "high beta": 47, "undervalued": 49}
    assert {k: got[k][0] for k in filings} == filings
    assert {k: got[k][1] for k in companies} == companies
