"""Named queries over the driver tables: ``name → fn(spark, sf_dir) -> DataFrame``.

Every entry derives its inputs from the driver tables with Spark, over the
whole tables, so its work grows with the data.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import semantic as S
from ..session import scratch_path, session_key
from ..sources import files, landed
from ..sources.tables import TableSource
from ..operators.quality import conflicting_values, missing_keys
from . import catalog, queries as Q, star as K, views as V
from .queries import DEFAULT, QUERIES, Params

QueryFn = Callable[[SparkSession, str], DataFrame]


def _star(spark: SparkSession, sf_dir: str) -> K.Star:
    """The star published once per session and source folder (see
    :func:`catalog.published_star`); tables are written on first use."""
    key = (session_key(spark), sf_dir.rstrip("/"))
    return catalog.published_star(
        spark, key, lambda: K.star_from_driver(spark, sf_dir), scratch_path(spark, "published_star")
    )


def profiles_normalised(spark, sf_dir):
    return _star(spark, sf_dir).table("dim_companies")


def profiles_quarantine(spark, sf_dir):
    raw = K.landed_inputs(spark, sf_dir)
    return K.profile_quarantine(raw["raw_profiles"], raw["raw_prices"], raw["raw_statements"])


def universe_flatten(spark, sf_dir):
    """Nested universe records → one row per listed company."""
    from ..sources.universe import flatten_universe_column

    return flatten_universe_column(landed.raw_universe_nested(TableSource(spark, sf_dir)))


def sector_reference(spark, sf_dir):
    """Sector coverage: the reference sector list against the companies' sector labels.

    Full outer join, so listed sectors without companies show 0 and company
    labels missing from the list show up with a NULL description (the
    source's label may differ from the curated list).
    """
    star = _star(spark, sf_dir)
    counts = star.dim_companies.groupBy("sector").agg(F.count(F.lit(1)).alias("companies"))
    return star.dim_sectors.join(counts, F.col("sector_name") == F.col("sector"), "full").select(
        F.coalesce("sector_name", "sector").alias("sector_name"),
        "description",
        F.coalesce("companies", F.lit(0)).cast("bigint").alias("companies"),
    )


def prices_with_returns(spark, sf_dir):
    return _star(spark, sf_dir).table("fact_stock_prices")


def prices_trailing_years(spark, sf_dir, p: Params = DEFAULT):
    """Bars of the trailing ``5 x 365`` days before ``as_of`` with returns inside that range."""
    start = F.date_sub(p.day, 365 * p.trailing_years)
    raw = landed.raw_prices(TableSource(spark, sf_dir), start, p.day)
    return K.stock_prices(raw)


def benchmark_with_returns(spark, sf_dir):
    return _star(spark, sf_dir).table("fact_sp500_benchmark")


def statements_pivot(spark, sf_dir):
    return K.statement_periods(K.landed_inputs(spark, sf_dir)["raw_statements"])


def financials(spark, sf_dir):
    return _star(spark, sf_dir).table("fact_financials")


def growth_padded(spark, sf_dir):
    fin = K.financials(K.landed_inputs(spark, sf_dir)["raw_statements"], pad=True)
    return fin.select("ticker", "fiscal_year", "revenue", "net_income", "revenue_growth_pct", "net_income_growth_pct")


def indicators_long(spark, sf_dir):
    return _star(spark, sf_dir).table("fact_economic_indicators")


def indicators_from_tsv(spark, sf_dir):
    """Land the wide panel as a tab-separated file, scan it back, reshape it."""
    path = scratch_path(spark, "panel_tsv")
    files.write_delimited_panel(landed.raw_indicator_panel(TableSource(spark, sf_dir)), path)
    return K.indicators(files.read_delimited_panel(spark, path), K.driver_indicator_spec())


def _view(name):
    def fn(spark, sf_dir):
        return V.VIEWS[name](_star(spark, sf_dir))

    fn.__name__ = name
    return fn


def _query(fn):
    def run(spark, sf_dir):
        return fn(_star(spark, sf_dir), DEFAULT)

    run.__name__ = fn.__name__
    return run


FUNDAMENTAL_EXPRESSIONS = [m.name for m in S.EXPRESSIONS[:11]]
PRICE_EXPRESSIONS = ["daily_return", "price_range", "price_range_pct"]


def m_expr_fundamentals(spark, sf_dir):
    fund = V.company_fundamentals(_star(spark, sf_dir))
    out = S.apply_expressions(fund, FUNDAMENTAL_EXPRESSIONS)
    return out.select("ticker", "fiscal_year", *FUNDAMENTAL_EXPRESSIONS)


def m_expr_prices(spark, sf_dir):
    perf = V.stock_performance(_star(spark, sf_dir))
    return S.apply_expressions(perf, PRICE_EXPRESSIONS).select("ticker", "trade_date", *PRICE_EXPRESSIONS)


def m_measures(spark, sf_dir):
    star = _star(spark, sf_dir)
    vol = S.run_metric(V.stock_performance(star), ["sector"], ["avg_daily_volume"])
    exc = S.run_metric(V.stock_vs_benchmark(star), ["sector"], ["avg_excess_return"])
    return vol.join(exc, "sector", "full").select("sector", "avg_daily_volume", "avg_excess_return")


def m_filters(spark, sf_dir):
    fund = V.company_fundamentals(_star(spark, sf_dir))
    return S.filter_counts(fund, [m.name for m in S.FILTERS])


def m_run_metric(spark, sf_dir):
    return S.run_metric(
        V.stock_vs_benchmark(_star(spark, sf_dir)),
        dims=["sector", "trade_year"],
        measures=["avg_excess_return"],
        filters=["high beta"],
    )


def m_synonyms(spark, sf_dir):
    """A metric asked for in business terms, in the asker's capitals, shown at two places."""
    fund = V.company_fundamentals(_star(spark, sf_dir))
    return S.present(S.run_metric(fund, dims=["sector"], measures=["Top Line", "bottom line", "ROE", "p/e"], filters=["profitable"]))


def latest_sector_outperformance(spark, sf_dir):
    """L17 for the year of the most recent trading day, found by a subquery of the same plan."""
    star = _star(spark, sf_dir)
    return Q.l17_sector_outperformance(star, Params.latest(star))


def latest_ytd_best(spark, sf_dir):
    star = _star(spark, sf_dir)
    return Q.l22_ytd_best(star, Params.latest(star))


# ---- landed files: the same records written out and read back through the file readers


def _landed(spark, name, df, fmt="parquet"):
    path = scratch_path(spark, f"landed_{name}")
    df.write.format(fmt).save(path)
    return path


def _profile_json(spark, sf_dir):
    return files.read_checked_profiles(spark, _landed(spark, "profiles", landed.profile_lines(TableSource(spark, sf_dir)), "text"))


def companies_from_json(spark, sf_dir):
    """``dim_companies`` from JSON lines of which some are cut, some have no ticker, some a word for a number."""
    return K.companies(_profile_json(spark, sf_dir)[0])


def profiles_rejected(spark, sf_dir):
    """What the landed JSON lines lost and why, with the tickers that lack bars or statements."""
    raw = K.landed_inputs(spark, sf_dir)
    profiles, checked = _profile_json(spark, sf_dir)
    return K.profile_quarantine(profiles, raw["raw_prices"], raw["raw_statements"], checked)


def tickers_without_bars(spark, sf_dir, p: Params = DEFAULT):
    """Companies without a single bar in the three days before ``as_of``."""
    src = TableSource(spark, sf_dir)
    recent = landed.raw_prices(src, F.date_sub(p.day, 3), p.day)
    return missing_keys(landed.raw_profiles(src), recent, "ticker", "prices", "no price rows")


def prices_from_files(spark, sf_dir):
    """Bars landed as JSON, read with their declared types, returns computed."""
    path = _landed(spark, "prices", K.landed_inputs(spark, sf_dir)["raw_prices"], "json")
    return K.stock_prices(files.read_prices(spark, path, "json"))


def prices_padded(spark, sf_dir):
    """Returns over bars with missing closes: the last known close is carried over the gap."""
    raw = landed.prices_with_gaps(K.landed_inputs(spark, sf_dir)["raw_prices"])
    return K.stock_prices(raw, pad=True)


def index_from_files(spark, sf_dir):
    path = _landed(spark, "index", K.landed_inputs(spark, sf_dir)["raw_index"])
    return K.benchmark(files.read_index(spark, path))


def index_repeated_days(spark, sf_dir):
    """Days that a landed index claims more than once."""
    return K.duplicate_days(landed.index_with_repeats(K.landed_inputs(spark, sf_dir)["raw_index"]))


def index_quarantined(spark, sf_dir):
    """The index without its repeated days, returns taken from one unique day to the next."""
    return K.benchmark(landed.index_with_repeats(K.landed_inputs(spark, sf_dir)["raw_index"]), on_duplicate="quarantine")


def financials_from_files(spark, sf_dir):
    """Statements landed with NaN for a missing figure, read and pivoted."""
    path = _landed(spark, "statements", landed.statements_with_nan(K.landed_inputs(spark, sf_dir)["raw_statements"]))
    return K.financials(files.read_statements(spark, path))


def statement_conflicts(spark, sf_dir):
    """Line items that landed with different values for one period (the pivot takes the highest)."""
    raw = landed.statements_restated(K.landed_inputs(spark, sf_dir)["raw_statements"])
    return conflicting_values(raw, ["ticker", "statement", "period_end", "line_item"], "value")


def indicators_from_panels(spark, sf_dir):
    """Two deliveries of the panel with other years and another column order, united by name."""
    wide = landed.raw_indicator_panel(TableSource(spark, sf_dir))
    folder = scratch_path(spark, "panels")
    for name, part in zip(("even", "odd"), landed.panel_halves(wide)):
        files.write_delimited_panel(part, f"{folder}/{name}")
    spec = K.driver_indicator_spec()
    columns = [*K.WIDE_ID_COLUMNS, *[str(y) for y in landed.PANEL_YEARS]]
    return K.indicators(files.read_panels(spark, f"{folder}/*", columns), spec)


def sql_sector_volume(spark, sf_dir):
    """A question asked as SQL text over the registered tables and views."""
    star = _star(spark, sf_dir)
    V.register_temp_views(spark, star)
    return spark.sql(
        "SELECT v.sector, v.trade_year, SUM(v.volume) AS volume, COUNT(DISTINCT c.exchange) AS exchanges "
        "FROM vw_stock_performance v JOIN dim_companies c ON v.ticker = c.ticker "
        "WHERE v.volume > 0 GROUP BY v.sector, v.trade_year"
    )


def preview_companies(spark, sf_dir):
    """The first rows of a table in the order of its key."""
    return catalog.preview(_star(spark, sf_dir).table("dim_companies").orderBy("ticker"), 5)


COMMENTS_SCHEMA = "marketstar_comments"


def catalog_comments(spark, sf_dir):
    """Comments of the published tables and views after a second full overwrite, with each object's rows."""
    star = _star(spark, sf_dir)
    with catalog.using_schema(spark, COMMENTS_SCHEMA):
        for _ in range(2):
            catalog.publish(spark, star, COMMENTS_SCHEMA, location=scratch_path(spark, "comments"))
    published = catalog.star_from_catalog(spark, COMMENTS_SCHEMA)
    rows = Q.inventory(published, "notebook", "object_rows").withColumnRenamed("object", "o")
    notes = catalog.comments(spark, COMMENTS_SCHEMA)
    return notes.join(rows, F.col("object") == F.col("o")).select("object", "column_name", "comment", "object_rows")


ROUNDTRIP_SCHEMA = "marketstar_roundtrip"


def table_roundtrip(spark, sf_dir):
    """Overwrite ``dim_companies`` in the catalog, comment it, read it back."""
    star = _star(spark, sf_dir)
    name = catalog.qualified(ROUNDTRIP_SCHEMA, "dim_companies")
    fields, comment = K.schemas.TABLES["dim_companies"]
    location = scratch_path(spark, "roundtrip_dim_companies")
    with catalog.using_schema(spark, ROUNDTRIP_SCHEMA):
        catalog.save_with_comments(spark, star.table("dim_companies"), name, fields, comment, location=location)
    return spark.table(name)


def registry() -> dict[str, QueryFn]:
    reg: dict[str, QueryFn] = {
        "profiles_normalised": profiles_normalised,
        "profiles_quarantine": profiles_quarantine,
        "sector_reference": sector_reference,
        "universe_flatten": universe_flatten,
        "prices_with_returns": prices_with_returns,
        "prices_trailing_years": prices_trailing_years,
        "benchmark_with_returns": benchmark_with_returns,
        "statements_pivot": statements_pivot,
        "financials": financials,
        "growth_padded": growth_padded,
        "indicators_long": indicators_long,
        "indicators_from_tsv": indicators_from_tsv,
        "view_company_fundamentals": _view("vw_company_fundamentals"),
        "view_stock_performance": _view("vw_stock_performance"),
        "view_stock_vs_benchmark": _view("vw_stock_vs_benchmark"),
        "view_economic_overview": _view("vw_economic_overview"),
    }
    reg.update({name: _query(fn) for name, fn in QUERIES.items()})
    reg.update(
        {
            "m_expr_fundamentals": m_expr_fundamentals,
            "m_expr_prices": m_expr_prices,
            "m_measures": m_measures,
            "m_filters": m_filters,
            "m_run_metric": m_run_metric,
            "m_synonyms": m_synonyms,
            "q_latest_sector_outperformance": latest_sector_outperformance,
            "q_latest_ytd_best": latest_ytd_best,
            "companies_from_json": companies_from_json,
            "profiles_rejected": profiles_rejected,
            "tickers_without_bars": tickers_without_bars,
            "prices_from_files": prices_from_files,
            "prices_padded": prices_padded,
            "index_from_files": index_from_files,
            "index_repeated_days": index_repeated_days,
            "index_quarantined": index_quarantined,
            "financials_from_files": financials_from_files,
            "statement_conflicts": statement_conflicts,
            "indicators_from_panels": indicators_from_panels,
            "sql_sector_volume": sql_sector_volume,
            "preview_companies": preview_companies,
            "catalog_comments": catalog_comments,
            "table_roundtrip": table_roundtrip,
        }
    )
    return reg
