"""Star schema: landed records → two dimensions and four facts.

Every transform is a lazy DataFrame plan; nothing runs on the driver.  A
:class:`Star` bundles the six tables so views and queries can be written
once and run either over lazily derived tables (straight from the landed
records) or over materialised tables (see :mod:`marketstar.plans.catalog`).
"""

from __future__ import annotations

import threading
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.exprs import (
    R,
    default,
    dividend_yield,
    falsy_or,
    nan_to_null,
    payout_percent,
    projection_flag,
    safe_pct,
    safe_ratio,
    with_calendar_change,
    with_period_change,
)
from ..operators.quality import missing_keys, quarantined
from ..operators.reshape import pivot_periods, unpivot_years
from ..sources import landed, universe
from ..sources.files import MALFORMED, NO_KEY
from ..sources.tables import TableSource

# ------------------------------------------------------------------ K1 / K2

# Defaults the reference writes for a missing profile field
# or a failed profile fetch.
UNKNOWN = "Unknown"
DEFAULT_COUNTRY = "United States"
DEFAULT_CURRENCY = "USD"

_PROFILE_NUMBERS = [
    "trailing_pe",
    "forward_pe",
    "price_to_book",
    "beta",
    "fifty_two_week_high",
    "fifty_two_week_low",
]


def companies(raw_profiles: DataFrame) -> DataFrame:
    """``dim_companies`` from profile records.

    A record with ``fetch_error`` becomes the default row (curated sector,
    ``Unknown``/``United States``/``USD``, zeros).  Otherwise missing fields
    take the same defaults, the price falls back current → regular → 0
    (zero counts as missing), and yield/payout are derived.
    """
    failed = F.col("fetch_error").isNotNull()

    def pick(value, fallback):
        return F.when(failed, F.lit(fallback)).otherwise(value)

    rate = default("dividend_rate", 0.0)
    price = falsy_or("current_price", falsy_or("regular_market_price", F.lit(0.0)))
    cols = [
        F.col("ticker"),
        F.col("company_name"),
        F.when(failed, F.col("curated_sector"))
        .otherwise(F.coalesce("sector", "curated_sector"))
        .alias("sector"),
        pick(default("industry", UNKNOWN), UNKNOWN).alias("industry"),
        pick(default("country", DEFAULT_COUNTRY), DEFAULT_COUNTRY).alias("headquarters_country"),
        pick(default("market_cap", 0.0), 0.0).alias("market_cap"),
        pick(default("employees", 0), 0).cast("bigint").alias("employees"),
        pick(default("exchange", UNKNOWN), UNKNOWN).alias("exchange"),
        pick(default("currency", DEFAULT_CURRENCY), DEFAULT_CURRENCY).alias("currency"),
        pick(dividend_yield(rate, price), 0.0).alias("dividend_yield"),
        pick(rate, 0.0).alias("dividend_rate"),
    ]
    numbers = {n: pick(default(n, 0.0), 0.0).alias(n) for n in _PROFILE_NUMBERS}
    payout = pick(payout_percent(default("payout_ratio", 0.0)), 0.0).alias("payout_ratio")
    cols += [numbers["trailing_pe"], numbers["forward_pe"], numbers["price_to_book"], payout]
    cols += [numbers["beta"], numbers["fifty_two_week_high"], numbers["fifty_two_week_low"]]
    return raw_profiles.select(*cols)


def profile_quarantine(
    raw_profiles: DataFrame, raw_prices: DataFrame, raw_statements: DataFrame, checked: DataFrame | None = None
) -> DataFrame:
    """Failed profile fetches plus tickers with no bars / no income statement.

    ``checked`` (see ``files.checked_records``) adds the landed records that
    are none or have no ticker: ``(ticker, stage, error)`` with a NULL ticker,
    one row per record.
    """
    universe_keys = raw_profiles.select("ticker")
    income = raw_statements.where(F.col("statement") == "income")
    out = (
        quarantined(raw_profiles, "ticker", "fetch_error", "profile")
        .unionByName(missing_keys(universe_keys, raw_prices, "ticker", "prices", "no price rows"))
        .unionByName(missing_keys(universe_keys, income, "ticker", "statements", "no income statement"))
    )
    if checked is not None:
        lost = checked.where(F.col("record_error").isin(MALFORMED, NO_KEY)).select(F.lit(None).cast("string").alias("ticker"), F.lit("landing").alias("stage"), F.col("record_error").alias("error"))
        out = out.unionByName(lost)
    return out


# ------------------------------------------------------------------ K4 / K5

_BAR_COLS = ["trade_date", "open_price", "high_price", "low_price", "close_price", "volume"]


def stock_prices(raw_prices: DataFrame, pad: bool = False) -> DataFrame:
    """``fact_stock_prices``: bars plus the close-to-close return per ticker.

    Over bars bucketed by ticker there is no exchange, else one hash exchange
    on ``ticker``; then a sort inside each partition.  A ticker holds at most one row per calendar day, so no window partition
    can grow with the data volume.
    """
    out = with_period_change(
        raw_prices, "close_price", "daily_return_pct", ["ticker"], ["trade_date"], pad=pad, fill_first=0.0
    )
    return out.select("ticker", *_BAR_COLS, "daily_return_pct")


def duplicate_days(raw_index: DataFrame) -> DataFrame:
    """Days that several index rows claim: ``(trade_date, rows, lowest_close, highest_close)``."""
    days = raw_index.groupBy("trade_date").agg(
        F.count(F.lit(1)).alias("rows"), F.min("close_price").alias("lowest_close"), F.max("close_price").alias("highest_close")
    )
    return days.where(F.col("rows") > 1)


def one_row_per_day(raw_index: DataFrame, on_duplicate: str = "raise") -> DataFrame:
    """The index with unique days: a day of several rows fails the query, or is left out (``"quarantine"``, see
    :func:`duplicate_days`).  One hash aggregation; no row is chosen over another."""
    if on_duplicate not in ("raise", "quarantine"):
        raise ValueError(f"unknown rule {on_duplicate!r}")
    values = [c for c in _BAR_COLS if c != "trade_date"]
    days = raw_index.groupBy("trade_date").agg(F.count(F.lit(1)).alias("__rows"), *[F.first(c).alias(c) for c in values])
    if on_duplicate == "quarantine":
        return days.where(F.col("__rows") == 1).drop("__rows")
    text = F.concat(F.lit("index has "), F.col("__rows").cast("string"), F.lit(" rows of day "), F.coalesce(F.col("trade_date").cast("string"), F.lit("NULL")))
    day = F.when(F.col("__rows") == 1, F.col("trade_date")).otherwise(F.raise_error(text).cast("date"))
    return days.select(day.alias("trade_date"), *values)


def benchmark(raw_index: DataFrame, pad: bool = False, on_duplicate: str = "raise") -> DataFrame:
    """``fact_sp500_benchmark``: index bars plus daily return.

    One row per day is checked, not assumed.  The return looks at the previous
    trading day inside its year, and across years through one row per year, so
    no task holds the whole series.
    """
    daily = one_row_per_day(raw_index, on_duplicate)
    out = with_calendar_change(daily, "close_price", "daily_return_pct", "trade_date", pad=pad, fill_first=0.0)
    return out.select(*_BAR_COLS, "daily_return_pct")


# ------------------------------------------------------------------ K6 - K9

# Statement line-item labels → working column names.
STATEMENT_ITEMS = {
    "Total Revenue": "revenue",
    "Cost Of Revenue": "cost_of_revenue",
    "Gross Profit": "gross_profit",
    "Operating Income": "operating_income_reported",
    "EBIT": "ebit",
    "Net Income": "net_income",
    "Diluted EPS": "eps_diluted",
    "Basic EPS": "eps_basic",
    "Total Assets": "total_assets",
    "Total Liabilities Net Minority Interest": "total_liabilities",
    "Stockholders Equity": "stockholders_equity",
    "Cash And Cash Equivalents": "cash",
    "Long Term Debt": "long_term_debt",
    "Current Assets": "current_assets",
    "Current Liabilities": "current_liabilities",
    "Operating Cash Flow": "operating_cash_flow",
}


def statement_periods(raw_statements: DataFrame) -> DataFrame:
    """One row per (ticker, income-statement period) with the 14 raw items.

    Balance-sheet and cash-flow items are aligned on the income periods:
    a period without income rows is dropped, an income period without a
    balance sheet keeps NULL balance items.  NaN values become NULL.
    """
    clean = raw_statements.withColumn("value", nan_to_null("value"))
    wide = pivot_periods(
        clean,
        ["ticker", "period_end"],
        "line_item",
        "value",
        STATEMENT_ITEMS,
        group_col="statement",
        groups=landed.STATEMENT_OF_ITEM,
        anchor=("statement", "income"),
    )
    return wide.select(
        "ticker",
        F.year("period_end").cast("int").alias("fiscal_year"),
        "period_end",
        "revenue",
        "cost_of_revenue",
        "gross_profit",
        falsy_or("operating_income_reported", "ebit").alias("operating_income"),
        "net_income",
        falsy_or("eps_diluted", "eps_basic").alias("eps"),
        "total_assets",
        "total_liabilities",
        "stockholders_equity",
        "cash",
        "long_term_debt",
        "current_assets",
        "current_liabilities",
        "operating_cash_flow",
    )


def with_ratios(periods: DataFrame) -> DataFrame:
    """The seven percent ratios and three plain ratios of a statement row."""
    return periods.withColumns(
        {
            "gross_margin_pct": safe_pct("gross_profit", "revenue"),
            "operating_margin_pct": safe_pct("operating_income", "revenue"),
            "net_margin_pct": safe_pct("net_income", "revenue"),
            "return_on_assets_pct": safe_pct("net_income", "total_assets"),
            "return_on_equity_pct": safe_pct("net_income", "stockholders_equity"),
            "current_ratio": safe_ratio("current_assets", "current_liabilities"),
            "debt_to_equity": safe_ratio("long_term_debt", "stockholders_equity"),
            "debt_ratio_pct": safe_pct("total_liabilities", "total_assets"),
            "cash_flow_margin_pct": safe_pct("operating_cash_flow", "revenue"),
            "debt_to_asset_ratio": safe_ratio("total_liabilities", "total_assets"),
        }
    )


def with_growth(df: DataFrame, pad: bool = False) -> DataFrame:
    """Revenue and net-income growth against the ticker's previous period.

    Ordered by ``period_end`` (two periods can share a fiscal year).  A zero
    base gives NULL; a negative base keeps its sign.  ``pad`` carries the
    last known value over gaps first, as pandas' default ``pct_change`` does.
    """
    order = ["period_end"] if "period_end" in df.columns else ["fiscal_year"]
    for src, out in (("revenue", "revenue_growth_pct"), ("net_income", "net_income_growth_pct")):
        df = with_period_change(df, src, out, ["ticker"], order, pad=pad)
        df = df.withColumn(out, R(out, 2))
    return df


def financials(raw_statements: DataFrame, pad: bool = False) -> DataFrame:
    """``fact_financials``: 14 items, 10 ratios and 2 growth columns."""
    out = with_growth(with_ratios(statement_periods(raw_statements)), pad=pad)
    return out.select(*schemas.names(schemas.FACT_FINANCIALS))


# ------------------------------------------------------------------ K10

# Identifier headers of the wide indicator file, as the
# source publishes them (a real file is read with exactly these names).
WIDE_ID_COLUMNS = ("ISO", "Country", "WEO Subject Code", "Estimates Start After")
YEAR_RANGE = [str(y) for y in range(2015, 2031)]


@dataclass(frozen=True)
class IndicatorSpec:
    """Which rows of a wide indicator panel to keep and how to name them."""

    codes: dict  # subject code → readable name
    countries: tuple  # country names to keep (before renames)
    renames: dict = field(default_factory=dict)  # country name → new name
    years: tuple = tuple(YEAR_RANGE)


def indicators(wide: DataFrame, spec: IndicatorSpec) -> DataFrame:
    """``fact_economic_indicators`` from a wide all-string panel.

    Row filter first (pushed to the scan), then unpivot only the year
    columns the panel has, drop the sentinels, strip thousands separators,
    ``try_cast`` (a bad cell is dropped, not an error), map codes and
    country renames through literal maps, round to 3 places and flag
    projections.
    """
    code_map = F.create_map(*[F.lit(x) for kv in spec.codes.items() for x in kv])
    rename_map = F.create_map(*[F.lit(x) for kv in spec.renames.items() for x in kv]) if spec.renames else None
    iso, country, code, est = WIDE_ID_COLUMNS
    kept = wide.where(F.col(code).isin(list(spec.codes)) & F.col(country).isin(list(spec.countries)))
    years = [y for y in spec.years if y in wide.columns]
    slim = kept.select(
        F.col(iso).alias("country_code"),
        F.col(country).alias("country_raw"),
        F.col(code).alias("indicator_code"),
        F.col(est).alias("estimates_start"),
        *[F.col(f"`{y}`") for y in years],
    )
    long = unpivot_years(slim, ["country_code", "country_raw", "indicator_code", "estimates_start"], years)
    value = F.translate(F.col("value_str"), ",", "").try_cast("double")
    renamed = (
        F.coalesce(rename_map[F.col("country_raw")], F.col("country_raw")) if rename_map is not None else F.col("country_raw")
    )
    out = (
        long.where(F.col("value_str").isNotNull() & ~F.col("value_str").isin("n/a", "--"))
        .withColumn("value", value)
        .where(F.col("value").isNotNull())
        .withColumn("year", F.col("year_str").try_cast("int"))
    )
    return out.select(
        "country_code",
        renamed.alias("country"),
        "indicator_code",
        code_map[F.col("indicator_code")].alias("indicator_name"),
        "year",
        R("value", 3).alias("value"),
        projection_flag("year", "estimates_start").alias("is_projection"),
    )


def driver_indicator_spec() -> IndicatorSpec:
    """Indicator parameters for the driver panel (priorities as subject codes)."""
    codes = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return IndicatorSpec(
        codes={c: f"IND {c}" for c in codes},
        countries=tuple(f"NATION_{i}" for i in range(25)),
        renames={"NATION_13": "South NATION_13"},
    )


# ------------------------------------------------------------------ bundle


class Lazy(dict):
    """A mapping whose values are built on first access from zero-arg callables."""

    def __init__(self, builders: dict):
        super().__init__()
        self._builders = dict(builders)

    def __missing__(self, key):
        value = self._builders[key]()
        self[key] = value
        return value

    def __contains__(self, key):
        return key in self._builders

    def names(self):
        return list(self._builders)


TABLE_NAMES = (
    "dim_companies",
    "dim_sectors",
    "fact_stock_prices",
    "fact_sp500_benchmark",
    "fact_financials",
    "fact_economic_indicators",
)


class Star:
    """The six star-schema tables (lazy plans or table scans).

    Each table is given as a DataFrame or as a zero-argument builder; a
    builder runs on first access only, so a query that reads one table never
    plans the other five.
    """

    def __init__(self, raw: dict | None = None, **tables):
        missing = [n for n in TABLE_NAMES if n not in tables]
        if missing:
            raise TypeError(f"missing tables: {missing}")
        self._tables = Lazy({n: (t if callable(t) else (lambda t=t: t)) for n, t in tables.items()})
        self.raw = raw if raw is not None else {}

    @property
    def clustered(self) -> int | None:
        """Buckets by ticker that the price fact's rows come in, if they derive from staged bars."""
        return self.raw["clustered"] if "clustered" in self.raw else None

    def __getattr__(self, name):
        if name in TABLE_NAMES:
            return self._tables[name]
        raise AttributeError(name)

    def table(self, name: str) -> DataFrame:
        """One table with exactly its declared columns (storage-only columns
        such as a partition key are projected away)."""
        df = self._tables[name]
        cols = schemas.names(schemas.TABLES[name][0])
        return df if df.columns == cols else df.select(*cols)

    def tables(self) -> dict[str, DataFrame]:
        return {n: self.table(n) for n in TABLE_NAMES}


_STAGED_BARS: dict = {}
_STAGE_LOCK = threading.Lock()


def staged_bars(spark: SparkSession, src: TableSource) -> DataFrame:
    """Daily bars written once per session and source folder, then scanned.

    Prices, index and statements derive from the bars; staging them makes the
    line-item aggregation run once instead of once per consumer.  They are
    bucketed and sorted by ticker, so returns and yearly sums per ticker need
    no further exchange.  The number of buckets follows the line items, so a
    task's rows stay as many however large the data.  The driver tables are read-only, so a staged copy
    stays valid.
    """
    from ..session import scratch_path, session_key  # local import: session is optional for pure plans
    from .catalog import ROWS_PER_BUCKET, bucket_count, write_bucketed

    key = (session_key(spark), src.root)
    with _STAGE_LOCK:  # concurrent table builds wait for one staging job
        if key not in _STAGED_BARS:
            buckets = bucket_count(src.lineitem.count())  # rows per file, from the files' footers
            bars = landed.daily_bars_by_ticker(src, buckets, ROWS_PER_BUCKET)
            _STAGED_BARS[key] = write_bucketed(bars, "daily_bars", scratch_path(spark, "daily_bars"), buckets, ["ticker", "trade_date"])
        return _STAGED_BARS[key]


def landed_inputs(spark: SparkSession, sf_dir: str, stage_bars: bool = True) -> dict[str, DataFrame]:
    """Landed raw inputs derived from the driver tables (lazy; bars optionally staged)."""
    from .catalog import bucket_count

    src = TableSource(spark, sf_dir)
    raw = Lazy(
        {
            "bars": (lambda: staged_bars(spark, src)) if stage_bars else (lambda: landed.daily_bars(src)),
            "raw_profiles": lambda: landed.raw_profiles(src),
            "raw_prices": lambda: landed.prices_from_bars(raw["bars"]),
            "raw_index": lambda: landed.index_from_bars(raw["bars"]),
            "raw_statements": lambda: landed.raw_statements(src, raw["bars"]),
            "raw_panel": lambda: landed.raw_indicator_panel(src),
            "clustered": lambda: bucket_count(src.lineitem.count()) if stage_bars else None,
        }
    )
    return raw


def build_star(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    spec: IndicatorSpec | None = None,
    pad_returns: bool = False,
    pad_growth: bool = False,
) -> Star:
    spec = spec or driver_indicator_spec()
    return Star(
        raw=raw,
        dim_companies=lambda: companies(raw["raw_profiles"]),
        dim_sectors=lambda: universe.sectors(spark),
        fact_stock_prices=lambda: stock_prices(raw["raw_prices"], pad=pad_returns),
        fact_sp500_benchmark=lambda: benchmark(raw["raw_index"], pad=pad_returns),
        fact_financials=lambda: financials(raw["raw_statements"], pad=pad_growth),
        fact_economic_indicators=lambda: indicators(raw["raw_panel"], spec),
    )


def star_from_driver(spark: SparkSession, sf_dir: str, stage_bars: bool = True, **kw) -> Star:
    """Star schema from the driver tables: one lazy plan per table (bars staged)."""
    return build_star(spark, landed_inputs(spark, sf_dir, stage_bars=stage_bars), **kw)
