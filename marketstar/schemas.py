"""Declared schemas for landed inputs and star-schema outputs.

Each output table is described as ``(name, type, comment)`` triples; the
comments are attached as column metadata and as catalog comments when a
table is written (see :mod:`marketstar.plans.catalog`).
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I, DT = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.DateType()


def struct(fields, nullable: bool = True) -> T.StructType:
    return T.StructType(
        [T.StructField(n, t, nullable, {"comment": c} if c else {}) for n, t, c in fields]
    )


# ---------------------------------------------------------------- landed inputs

RAW_PROFILE_FIELDS = [
    ("ticker", S, "listing symbol"),
    ("company_name", S, "company name from the universe"),
    ("curated_sector", S, "sector assigned by the universe"),
    ("sector", S, "sector reported by the profile source"),
    ("industry", S, None),
    ("country", S, None),
    ("exchange", S, None),
    ("currency", S, None),
    ("market_cap", D, None),
    ("employees", L, None),
    ("dividend_rate", D, None),
    ("current_price", D, None),
    ("regular_market_price", D, None),
    ("payout_ratio", D, None),
    ("trailing_pe", D, None),
    ("forward_pe", D, None),
    ("price_to_book", D, None),
    ("beta", D, None),
    ("fifty_two_week_high", D, None),
    ("fifty_two_week_low", D, None),
    ("fetch_error", S, "error text when the profile fetch failed"),
]
RAW_PROFILES = struct(RAW_PROFILE_FIELDS)

BAR_FIELDS = [
    ("trade_date", DT, None),
    ("open_price", D, None),
    ("high_price", D, None),
    ("low_price", D, None),
    ("close_price", D, None),
    ("volume", L, None),
]
RAW_PRICES = struct([("ticker", S, None)] + BAR_FIELDS)
RAW_INDEX = struct(BAR_FIELDS)

RAW_STATEMENTS = struct(
    [
        ("ticker", S, None),
        ("statement", S, "income | balance | cash_flow"),
        ("period_end", DT, None),
        ("line_item", S, None),
        ("value", D, None),
    ]
)

# ---------------------------------------------------------------- outputs

DIM_COMPANIES = [
    ("ticker", S, "Listing symbol; one row per company."),
    ("company_name", S, "Company name."),
    ("sector", S, "Sector label (source value, else the curated one)."),
    ("industry", S, "Industry within the sector."),
    ("headquarters_country", S, "Country of the head office."),
    ("market_cap", D, "Market value of equity in USD; 0 when unknown."),
    ("employees", L, "Full-time staff; 0 when unknown."),
    ("exchange", S, "Listing venue code."),
    ("currency", S, "Reporting currency."),
    ("dividend_yield", D, "Dividend rate over price, in percent; 0 means none."),
    ("dividend_rate", D, "Yearly dividend per share in USD."),
    ("trailing_pe", D, "Price over last-twelve-month earnings; 0 when unknown."),
    ("forward_pe", D, "Price over expected earnings; 0 when unknown."),
    ("price_to_book", D, "Price over book value per share."),
    ("payout_ratio", D, "Dividends as a percent of earnings."),
    ("beta", D, "Volatility relative to the market index."),
    ("fifty_two_week_high", D, "Highest price over 52 weeks."),
    ("fifty_two_week_low", D, "Lowest price over 52 weeks."),
]

DIM_SECTORS = [
    ("sector_name", S, "Sector label."),
    ("description", S, "What the sector contains."),
]

FACT_STOCK_PRICES = [
    ("ticker", S, "Listing symbol; joins dim_companies."),
    ("trade_date", DT, "Trading day."),
    ("open_price", D, "First trade price of the day."),
    ("high_price", D, "Highest price of the day."),
    ("low_price", D, "Lowest price of the day."),
    ("close_price", D, "Last trade price of the day; basis of returns."),
    ("volume", L, "Units traded in the day."),
    ("daily_return_pct", D, "Close over previous close minus one, in percent; 0 on the first day."),
]

FACT_BENCHMARK = [(n, t, c) for n, t, c in FACT_STOCK_PRICES if n != "ticker"]

FIN_RAW = [
    ("revenue", "Total revenue of the fiscal year."),
    ("net_income", "Profit after tax."),
    ("total_assets", "Total assets."),
    ("total_liabilities", "Total liabilities."),
    ("stockholders_equity", "Shareholders' equity."),
    ("eps", "Diluted earnings per share (basic when diluted is missing or zero)."),
    ("gross_profit", "Revenue minus cost of revenue."),
    ("operating_income", "Operating income (EBIT when missing or zero)."),
    ("operating_cash_flow", "Cash from operations."),
    ("cost_of_revenue", "Direct cost of revenue."),
    ("cash", "Cash and equivalents."),
    ("long_term_debt", "Debt due after one year."),
    ("current_assets", "Assets realisable within a year."),
    ("current_liabilities", "Obligations due within a year."),
]
FIN_RATIOS = [
    ("gross_margin_pct", "Gross profit over revenue, percent."),
    ("operating_margin_pct", "Operating income over revenue, percent."),
    ("net_margin_pct", "Net income over revenue, percent."),
    ("return_on_assets_pct", "Net income over total assets, percent."),
    ("return_on_equity_pct", "Net income over equity, percent."),
    ("current_ratio", "Current assets over current liabilities."),
    ("debt_to_equity", "Long-term debt over equity."),
    ("debt_ratio_pct", "Total liabilities over total assets, percent."),
    ("cash_flow_margin_pct", "Operating cash flow over revenue, percent."),
    ("debt_to_asset_ratio", "Total liabilities over total assets."),
    ("revenue_growth_pct", "Revenue change against the previous period, percent."),
    ("net_income_growth_pct", "Net income change against the previous period, percent."),
]
FACT_FINANCIALS = (
    [("ticker", S, "Listing symbol; joins dim_companies."), ("fiscal_year", I, "Calendar year of the period end.")]
    + [(n, D, c) for n, c in FIN_RAW]
    + [(n, D, c) for n, c in FIN_RATIOS]
)

FACT_ECONOMIC = [
    ("country_code", S, "Country code of the source file."),
    ("country", S, "Country name after renames."),
    ("indicator_code", S, "Source subject code."),
    ("indicator_name", S, "Readable indicator name."),
    ("year", I, "Calendar year of the value."),
    ("value", D, "Indicator value, rounded to 3 places."),
    ("is_projection", S, "Y when the year lies after the estimates start, else N."),
]

TABLES = {
    "dim_companies": (DIM_COMPANIES, "Company profiles, one row per ticker."),
    "dim_sectors": (DIM_SECTORS, "Sector reference list."),
    "fact_stock_prices": (FACT_STOCK_PRICES, "Daily bars per ticker with daily return."),
    "fact_sp500_benchmark": (FACT_BENCHMARK, "Daily bars of the market index with daily return."),
    "fact_financials": (FACT_FINANCIALS, "Yearly statement items, ratios and growth per ticker."),
    "fact_economic_indicators": (FACT_ECONOMIC, "Macro indicators per country and year, long form."),
}


def names(fields) -> list[str]:
    return [f[0] for f in fields]
