"""The four pre-joined views over a :class:`~marketstar.plans.star.Star`.

Join strategy:

* companies ⋈ price facts on ``ticker``: companies grow with the number of
  listed names, so they are counted first and broadcast only under
  ``MAX_BROADCAST_ROWS``; above it the join is a sort-merge join, and the
  price fact's return window already left it hash-partitioned on ``ticker``
  (no second exchange on the fact side).
* companies ⟕ financials: the preserved side cannot be broadcast and the
  statements grow with tickers x years, so Spark decides from size
  statistics (static threshold, then AQE at run time).
* prices ⋈ index on ``trade_date``: the index holds one row per calendar
  day, a bound independent of data volume, so it is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .star import Star

FUNDAMENTALS_COMPANY_COLS = [
    "ticker",
    "company_name",
    "sector",
    "industry",
    "headquarters_country",
    "market_cap",
    "employees",
    "dividend_yield",
    "dividend_rate",
    "trailing_pe",
    "forward_pe",
    "price_to_book",
    "payout_ratio",
    "beta",
    "fifty_two_week_high",
    "fifty_two_week_low",
]
FUNDAMENTALS_FACT_COLS = [
    "fiscal_year",
    "revenue",
    "net_income",
    "gross_profit",
    "operating_income",
    "operating_cash_flow",
    "total_assets",
    "total_liabilities",
    "stockholders_equity",
    "cash",
    "long_term_debt",
    "eps",
    "gross_margin_pct",
    "operating_margin_pct",
    "net_margin_pct",
    "return_on_assets_pct",
    "return_on_equity_pct",
    "current_ratio",
    "debt_to_equity",
    "debt_to_asset_ratio",
    "debt_ratio_pct",
    "cash_flow_margin_pct",
    "revenue_growth_pct",
    "net_income_growth_pct",
]


def _date_parts(col: str = "trade_date", stored_year: bool = False) -> list:
    """Calendar parts of the trade date.

    When the fact is stored partitioned by ``trade_year`` the stored column
    is used, so a year filter on the view prunes partition folders.
    """
    d = F.col(col)
    year = F.col("trade_year").cast("int") if stored_year else F.year(d).cast("int")
    return [
        year.alias("trade_year"),
        F.month(d).cast("int").alias("trade_month"),
        F.quarter(d).cast("int").alias("trade_quarter"),
    ]


def company_fundamentals(star: Star) -> DataFrame:
    """``vw_company_fundamentals``: every company, with each fiscal year it filed (left join)."""
    c = star.dim_companies.select(*FUNDAMENTALS_COMPANY_COLS)
    f = star.fact_financials.select("ticker", *FUNDAMENTALS_FACT_COLS)
    return c.join(f, "ticker", "left").select(*FUNDAMENTALS_COMPANY_COLS, *FUNDAMENTALS_FACT_COLS)


def stock_performance(star: Star) -> DataFrame:
    """``vw_stock_performance``: daily bars of profiled tickers with calendar parts."""
    c = star.dim_companies.select("ticker", "company_name", "sector", "industry", "market_cap")
    p = star.fact_stock_prices
    stored = "trade_year" in p.columns
    return p.join(c, "ticker").select(
        "ticker",
        "company_name",
        "sector",
        "industry",
        "market_cap",
        "trade_date",
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "volume",
        "daily_return_pct",
        *_date_parts(stored_year=stored),
    )


def stock_vs_benchmark(star: Star) -> DataFrame:
    """``vw_stock_vs_benchmark``: daily bars beside the index, with excess return."""
    c = star.dim_companies.select("ticker", "company_name", "sector", "industry", "beta")
    stored = "trade_year" in star.fact_stock_prices.columns
    keep = ["ticker", "trade_date", "close_price", "daily_return_pct"] + (["trade_year"] if stored else [])
    p = star.fact_stock_prices.select(*keep)
    b = star.fact_sp500_benchmark.select(
        "trade_date",
        F.col("close_price").alias("sp500_close"),
        F.col("daily_return_pct").alias("sp500_daily_return_pct"),
    )
    return (
        p.join(c, "ticker")
        .join(b, "trade_date")
        .select(
            "ticker",
            "company_name",
            "sector",
            "industry",
            "beta",
            "trade_date",
            "close_price",
            F.col("daily_return_pct").alias("stock_daily_return_pct"),
            "sp500_close",
            "sp500_daily_return_pct",
            (F.col("daily_return_pct") - F.col("sp500_daily_return_pct")).alias("excess_return_pct"),
            *_date_parts(stored_year=stored),
        )
    )


def economic_overview(star: Star) -> DataFrame:
    """``vw_economic_overview``: the indicator fact as published columns."""
    return star.fact_economic_indicators.select(
        "country_code", "country", "indicator_code", "indicator_name", "year", "value", "is_projection"
    )


VIEWS = {
    "vw_company_fundamentals": company_fundamentals,
    "vw_stock_performance": stock_performance,
    "vw_stock_vs_benchmark": stock_vs_benchmark,
    "vw_economic_overview": economic_overview,
}


def views(star: Star) -> dict[str, DataFrame]:
    return {name: fn(star) for name, fn in VIEWS.items()}


def register_temp_views(spark: SparkSession, star: Star) -> None:
    """Expose tables and views to ``spark.sql`` under their published names."""
    for name, df in {**star.tables(), **views(star)}.items():
        df.createOrReplaceTempView(name)
