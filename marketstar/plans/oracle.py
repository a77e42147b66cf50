"""Reference SQL for every registered query, runnable by DuckDB on the driver tables.

Each derived table is one CTE written directly against the driver tables
(``lineitem``, ``supplier`` ...), deliberately *not* mirroring the Spark
plans: the index is aggregated straight from line items instead of being
rolled up from supplier bars, statements are computed wide instead of
unpivoted and pivoted back, and indicators are aggregated long instead of
being pivoted to a wide panel and melted.  Agreement therefore checks the
Spark-side rewrites, not just the arithmetic.
"""

from __future__ import annotations

import datetime as _dt

from .. import schemas
from ..sources.universe import SECTORS
from .catalog import VIEW_COMMENTS
from .queries import DEFAULT, Params
from .views import FUNDAMENTALS_COMPANY_COLS, FUNDAMENTALS_FACT_COLS


def R(x: str, n: int) -> str:
    return f"cast(round(cast(cast(({x}) as varchar) as decimal(38,12)), {n}) as double)"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return ", ".join(_lit(v) for v in values)


_UNIT = "l_extendedprice / nullif(l_quantity, 0)"
_KEY = "(l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity)"


def _bars_sql(where: str = "") -> str:
    return f"""select concat('S', cast(l_suppkey as varchar)) as ticker, cast(l_shipdate as date) as trade_date,
  arg_min({_UNIT}, {_KEY}) as open_price, max({_UNIT}) as high_price, min({_UNIT}) as low_price,
  arg_max({_UNIT}, {_KEY}) as close_price, cast(sum(l_quantity) as bigint) as volume
from lineitem {where} group by l_suppkey, cast(l_shipdate as date)"""


def _returns_sql(src: str, partition: str) -> str:
    part = f"partition by {partition} " if partition else ""
    cols = "trade_date, open_price, high_price, low_price, close_price, volume"
    lead = f"{partition}, " if partition else ""
    return f"""select {lead}{cols},
  coalesce((close_price / nullif(lag(close_price) over ({part}order by trade_date), 0) - 1) * 100, 0e0) as daily_return_pct
from {src}"""


def _fallback(a: str, b: str) -> str:
    return f"case when coalesce({a}, 0e0) <> 0 then {a} else {b} end"


_NI = "(rev - qty * (14e2 + (k % 4) * 1e3))"
_OPI = "case when k % 10 = 0 then 0e0 when k % 9 <> 0 then rev - qty * 125e1 end"
_DEPS = f"case when k % 8 = 0 then 0e0 else {_NI} / 1e6 end"

_RATIOS = {
    "gross_margin_pct": ("gross_profit", "revenue", True),
    "operating_margin_pct": ("operating_income", "revenue", True),
    "net_margin_pct": ("net_income", "revenue", True),
    "return_on_assets_pct": ("net_income", "total_assets", True),
    "return_on_equity_pct": ("net_income", "stockholders_equity", True),
    "current_ratio": ("current_assets", "current_liabilities", False),
    "debt_to_equity": ("long_term_debt", "stockholders_equity", False),
    "debt_ratio_pct": ("total_liabilities", "total_assets", True),
    "cash_flow_margin_pct": ("operating_cash_flow", "revenue", True),
    "debt_to_asset_ratio": ("total_liabilities", "total_assets", False),
}

_FIN_RAW = (
    "revenue, net_income, total_assets, total_liabilities, stockholders_equity, eps, gross_profit, "
    "operating_income, operating_cash_flow, cost_of_revenue, cash, long_term_debt, current_assets, current_liabilities"
)


def _growth(col: str, pad: bool) -> str:
    src = f"{col}_filled" if pad else col
    return R(f"({src} / nullif(lag({src}) over (partition by ticker order by period_end), 0) - 1) * 100", 2)


def _financials_sql(pad: bool) -> str:
    ratios = ",\n  ".join(
        R(f"{n} / nullif({d}, 0)" + (" * 100" if pct else ""), 2) + f" as {name}"
        for name, (n, d, pct) in _RATIOS.items()
    )
    fill = ""
    if pad:
        fill = "".join(
            f", last_value({c} ignore nulls) over (partition by ticker order by period_end "
            f"rows between unbounded preceding and current row) as {c}_filled"
            for c in ("revenue", "net_income")
        )
    return f"""select ticker, fiscal_year, {_FIN_RAW},
  {ratios},
  {_growth('revenue', pad)} as revenue_growth_pct,
  {_growth('net_income', pad)} as net_income_growth_pct
from (select *{fill} from statement_periods) s"""


_COMPANY_COLS = (
    "c.ticker, c.company_name, c.sector, c.industry, c.headquarters_country, c.market_cap, c.employees, "
    "c.dividend_yield, c.dividend_rate, c.trailing_pe, c.forward_pe, c.price_to_book, c.payout_ratio, c.beta, "
    "c.fifty_two_week_high, c.fifty_two_week_low"
)
_FUND_FACT_COLS = (
    "f.fiscal_year, f.revenue, f.net_income, f.gross_profit, f.operating_income, f.operating_cash_flow, "
    "f.total_assets, f.total_liabilities, f.stockholders_equity, f.cash, f.long_term_debt, f.eps, "
    "f.gross_margin_pct, f.operating_margin_pct, f.net_margin_pct, f.return_on_assets_pct, "
    "f.return_on_equity_pct, f.current_ratio, f.debt_to_equity, f.debt_to_asset_ratio, f.debt_ratio_pct, "
    "f.cash_flow_margin_pct, f.revenue_growth_pct, f.net_income_growth_pct"
)
_PARTS = (
    "cast(year(p.trade_date) as integer) as trade_year, cast(month(p.trade_date) as integer) as trade_month, "
    "cast(quarter(p.trade_date) as integer) as trade_quarter"
)

_ERR = "fetch_error is not null"


def _keep(expr: str, fallback: str) -> str:
    return f"case when {_ERR} then {fallback} else {expr} end"


def _returns_padded_sql(src: str) -> str:
    """Returns against the previous known close of the ticker."""
    return f"""select ticker, trade_date, open_price, high_price, low_price, close_price, volume,
  coalesce((known / nullif(lag(known) over (partition by ticker order by trade_date), 0) - 1) * 100, 0e0) as daily_return_pct
from (select *, last_value(close_price ignore nulls) over (partition by ticker order by trade_date
        rows between unbounded preceding and current row) as known from {src})"""


CTES: dict[str, tuple[str, tuple]] = {
    "raw_profiles": (
        """select concat('S', cast(s_suppkey as varchar)) as ticker, s_name as company_name, r_name as curated_sector,
  case when s_suppkey % 11 <> 0 then r_name end as sector,
  case when s_suppkey % 13 <> 0 then n_name end as industry,
  case when s_suppkey % 17 <> 0 then n_name end as country,
  case when s_suppkey % 19 <> 0 then s_acctbal * 2e7 end as market_cap,
  case when s_suppkey % 7 <> 0 then cast(s_suppkey * 100 as bigint) end as employees,
  case when s_suppkey % 2 = 0 then 'NYQ' when s_suppkey % 9 <> 0 then 'NMS' end as exchange,
  case when s_suppkey % 21 <> 0 then 'USD' end as currency,
  case when s_suppkey % 3 <> 0 then (s_suppkey % 50) / 1e1 end as dividend_rate,
  case when s_suppkey % 7 <> 0 then 5e1 + s_suppkey % 100 end as current_price,
  case when s_suppkey % 14 <> 0 then 6e1 + s_suppkey % 90 end as regular_market_price,
  case when s_suppkey % 5 = 0 then 125e-1 when s_suppkey % 4 <> 0 then (s_suppkey % 90) / 1e2 end as payout_ratio,
  case when s_suppkey % 23 <> 0 then (s_suppkey % 40) * 1e0 end as trailing_pe,
  case when s_suppkey % 16 <> 0 then (s_suppkey % 35) * 1e0 end as forward_pe,
  (s_suppkey % 60) / 1e1 as price_to_book, (s_suppkey % 25) / 1e1 as beta,
  1e2 + s_suppkey % 70 as fifty_two_week_high, 4e1 + s_suppkey % 30 as fifty_two_week_low,
  case when s_suppkey % 37 = 0 then 'timeout' end as fetch_error
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
        (),
    ),
    "dim_companies": (
        f"""select ticker, company_name,
  {_keep('coalesce(sector, curated_sector)', 'curated_sector')} as sector,
  {_keep("coalesce(industry, 'Unknown')", "'Unknown'")} as industry,
  {_keep("coalesce(country, 'United States')", "'United States'")} as headquarters_country,
  {_keep('coalesce(market_cap, 0e0)', '0e0')} as market_cap,
  cast({_keep('coalesce(employees, 0)', '0')} as bigint) as employees,
  {_keep("coalesce(exchange, 'Unknown')", "'Unknown'")} as exchange,
  {_keep("coalesce(currency, 'USD')", "'USD'")} as currency,
  {_keep(f"case when px > 0 then {R('coalesce(dividend_rate, 0e0) / px * 100', 2)} else 0e0 end", '0e0')} as dividend_yield,
  {_keep('coalesce(dividend_rate, 0e0)', '0e0')} as dividend_rate,
  {_keep('coalesce(trailing_pe, 0e0)', '0e0')} as trailing_pe,
  {_keep('coalesce(forward_pe, 0e0)', '0e0')} as forward_pe,
  {_keep('coalesce(price_to_book, 0e0)', '0e0')} as price_to_book,
  {_keep(f"case when coalesce(payout_ratio, 0e0) <= 5 then {R('coalesce(payout_ratio, 0e0) * 100', 2)} else {R('coalesce(payout_ratio, 0e0)', 2)} end", '0e0')} as payout_ratio,
  {_keep('coalesce(beta, 0e0)', '0e0')} as beta,
  {_keep('coalesce(fifty_two_week_high, 0e0)', '0e0')} as fifty_two_week_high,
  {_keep('coalesce(fifty_two_week_low, 0e0)', '0e0')} as fifty_two_week_low
from (select *, {_fallback('current_price', _fallback('regular_market_price', '0e0'))} as px from raw_profiles) rp""",
        ("raw_profiles",),
    ),
    "landed_profiles": (
        """select * exclude (ticker, market_cap, fetch_error), k % 9 = 4 as cut,
  case when k % 10 <> 7 then ticker end as ticker,
  case when k % 9 <> 5 then market_cap end as market_cap,
  coalesce(fetch_error, case when k % 9 = 5 then 'market_cap is no double: abc' end) as fetch_error
from (select *, cast(ticker[2:] as bigint) as k from raw_profiles)""",
        ("raw_profiles",),
    ),
    "json_profiles": ("select * from landed_profiles where not cut and ticker is not null", ("landed_profiles",)),
    "dim_sectors": (
        "select * from (values "
        + ", ".join(f"({_lit(n)}, {_lit(d)})" for n, d in SECTORS)
        + ") as t(sector_name, description)",
        (),
    ),
    "raw_prices": (_bars_sql(), ()),
    "raw_index": (
        f"""select cast(l_shipdate as date) as trade_date,
  arg_min({_UNIT}, {_KEY}) as open_price, max({_UNIT}) as high_price, min({_UNIT}) as low_price,
  arg_max({_UNIT}, {_KEY}) as close_price, cast(sum(l_quantity) as bigint) as volume
from lineitem group by cast(l_shipdate as date)""",
        (),
    ),
    "fact_stock_prices": (_returns_sql("raw_prices", "ticker"), ("raw_prices",)),
    "fact_sp500_benchmark": (_returns_sql("raw_index", ""), ("raw_index",)),
    "prices_gappy": (
        "select * replace (case when day(trade_date) % 7 <> 0 then close_price end as close_price) from raw_prices",
        ("raw_prices",),
    ),
    "index_unique": ("select * from raw_index where day(trade_date) <> 5", ("raw_index",)),
    "stmt_base": (
        """select l_suppkey as k, cast(year(l_shipdate) as integer) as y,
  cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as rev, sum(l_quantity) as qty, count(*) as n
from lineitem group by l_suppkey, cast(year(l_shipdate) as integer)""",
        (),
    ),
    "statement_periods": (
        f"""select concat('S', cast(k as varchar)) as ticker, y as fiscal_year, make_date(y, 12, 31) as period_end,
  case when not (k % 29 = 0 and y % 3 = 0) then rev end as revenue,
  qty * 11e2 as cost_of_revenue,
  rev - qty * 11e2 as gross_profit,
  {_fallback(f'({_OPI})', 'rev - qty * 124e1')} as operating_income,
  {_NI} as net_income,
  {_fallback(f'({_DEPS})', f'{_NI} / 9e5')} as eps,
  rev * 2e0 as total_assets,
  rev * (12e-1 + (k % 5) / 1e1) + n * 1e3 as total_liabilities,
  case when k % 31 = 0 then 0e0 else rev * 7e-1 - n * 1e3 end as stockholders_equity,
  qty * 1e2 as cash,
  qty * 3e2 as long_term_debt,
  rev * 5e-1 as current_assets,
  qty * 4e2 as current_liabilities,
  rev - qty * 13e2 as operating_cash_flow
from stmt_base""",
        ("stmt_base",),
    ),
    "fact_financials": (_financials_sql(pad=False), ("statement_periods",)),
    "statement_periods_nan": (
        "select * replace (case when cast(ticker[2:] as bigint) % 6 <> 1 then revenue end as revenue) from statement_periods",
        ("statement_periods",),
    ),
    "fact_financials_nan": (
        _financials_sql(pad=False).replace("from statement_periods)", "from statement_periods_nan)"),
        ("statement_periods_nan",),
    ),
    "fact_financials_padded": (_financials_sql(pad=True), ("statement_periods",)),
    "panel_cells": (
        """select nk, n_name, code, y,
  case when (nk + y) % 17 = 0 then null when (nk + y) % 13 = 0 then '--' when (nk + y) % 11 = 0 then 'n/a'
       else format('{:,.3f}', v) end as cell
from (select c_nationkey as nk, o_orderpriority as code, cast(year(o_orderdate) as integer) + 20 as y,
        cast(sum(cast(o_totalprice as decimal(18,2))) as double) / 1e3 as v
      from orders join customer on o_custkey = c_custkey group by 1, 2, 3) a
join nation on nk = n_nationkey""",
        (),
    ),
    "fact_economic_indicators": (
        f"""select 'C' || cast(nk as varchar) as country_code,
  case when n_name = 'NATION_13' then 'South NATION_13' else n_name end as country,
  code as indicator_code, 'IND ' || code as indicator_name, y as year,
  {R("try_cast(replace(cell, ',', '') as double)", 3)} as value,
  case when not (nk % 6 = 0 and code = '5-LOW') and y > 2019 then 'Y' else 'N' end as is_projection
from panel_cells
where cell is not null and cell not in ('n/a', '--') and try_cast(replace(cell, ',', '') as double) is not null""",
        ("panel_cells",),
    ),
    "vw_company_fundamentals": (
        f"select {_COMPANY_COLS}, {_FUND_FACT_COLS} from dim_companies c left join fact_financials f on c.ticker = f.ticker",
        ("dim_companies", "fact_financials"),
    ),
    "vw_stock_performance": (
        f"""select c.ticker, c.company_name, c.sector, c.industry, c.market_cap, p.trade_date, p.open_price, p.high_price,
  p.low_price, p.close_price, p.volume, p.daily_return_pct, {_PARTS}
from dim_companies c join fact_stock_prices p on c.ticker = p.ticker""",
        ("dim_companies", "fact_stock_prices"),
    ),
    "vw_stock_vs_benchmark": (
        f"""select c.ticker, c.company_name, c.sector, c.industry, c.beta, p.trade_date, p.close_price,
  p.daily_return_pct as stock_daily_return_pct, b.close_price as sp500_close, b.daily_return_pct as sp500_daily_return_pct,
  p.daily_return_pct - b.daily_return_pct as excess_return_pct, {_PARTS}
from dim_companies c join fact_stock_prices p on c.ticker = p.ticker join fact_sp500_benchmark b on p.trade_date = b.trade_date""",
        ("dim_companies", "fact_stock_prices", "fact_sp500_benchmark"),
    ),
    "vw_economic_overview": (
        "select country_code, country, indicator_code, indicator_name, year, value, is_projection from fact_economic_indicators",
        ("fact_economic_indicators",),
    ),
}


def _companies_of(profiles: str) -> str:
    """The ``dim_companies`` statement over other profile records."""
    return CTES["dim_companies"][0].replace("from raw_profiles)", f"from {profiles})")


def _outperformance(year: str) -> str:
    return f"""select sector, {R('avg(stock_daily_return_pct)', 4)} as avg_sector_return,
  {R('avg(sp500_daily_return_pct)', 4)} as avg_sp500_return, {R('avg(excess_return_pct)', 4)} as avg_excess_return,
  count(distinct ticker) as stocks
from vw_stock_vs_benchmark where trade_year = {year} group by sector"""


def _ytd_best(year: str) -> str:
    return f"""select ticker, company_name, sector, {R('((last_price - first_price) / first_price) * 100', 2)} as ytd_return_pct
from (select ticker, company_name, sector, arg_min(close_price, trade_date) as first_price,
        arg_max(close_price, trade_date) as last_price
      from vw_stock_performance where trade_year = {year} group by ticker, company_name, sector) t
where first_price > 0 order by ytd_return_pct desc nulls last, ticker limit 10"""


_LATEST_YEAR = "(select year(max(trade_date)) from fact_sp500_benchmark)"


def _comment_rows() -> str:
    """The declared comments of tables, their columns and views; a view's column has the comment of the one it shows."""
    said = {t: {n: c for n, _, c in fields} for t, (fields, _) in schemas.TABLES.items()}
    rows = []
    for table, (fields, comment) in schemas.TABLES.items():
        rows.append((table, None, comment))
        rows += [(table, name, text) for name, _, text in fields]
    rows.append(("fact_stock_prices", "trade_year", None))  # the partition column of the stored fact
    c, p, b, f = (said[t] for t in ("dim_companies", "fact_stock_prices", "fact_sp500_benchmark", "fact_financials"))
    parts = {"trade_year": None, "trade_month": None, "trade_quarter": None}
    shown = {
        "vw_company_fundamentals": {n: c[n] for n in FUNDAMENTALS_COMPANY_COLS} | {n: f[n] for n in FUNDAMENTALS_FACT_COLS},
        "vw_stock_performance": {n: c[n] for n in ("ticker", "company_name", "sector", "industry", "market_cap")}
        | {n: t for n, t in p.items() if n != "ticker"}
        | parts,
        "vw_stock_vs_benchmark": {n: c[n] for n in ("ticker", "company_name", "sector", "industry", "beta")}
        | {n: p[n] for n in ("trade_date", "close_price")}
        | {"stock_daily_return_pct": p["daily_return_pct"], "sp500_close": b["close_price"]}
        | {"sp500_daily_return_pct": b["daily_return_pct"], "excess_return_pct": None}
        | parts,
        "vw_economic_overview": said["fact_economic_indicators"],
    }
    for view, columns in shown.items():
        rows.append((view, None, VIEW_COMMENTS[view]))
        rows += [(view, name, text) for name, text in columns.items()]
    text = lambda v: "cast(null as varchar)" if v is None else _lit(v)
    return ", ".join(f"({', '.join(map(text, r))})" for r in rows)


def with_ctes(body: str, needs) -> str:
    """Prefix ``body`` with the CTEs it needs, dependencies first."""
    order: list[str] = []

    def visit(name):
        if name in order:
            return
        for dep in CTES[name][1]:
            visit(dep)
        order.append(name)

    for n in needs:
        visit(n)
    if not order:
        return body
    return "with " + ",\n".join(f"{n} as (\n{CTES[n][0]}\n)" for n in order) + "\n" + body


def _table(name: str, cols: str = "*") -> str:
    return with_ctes(f"select {cols} from {name}", [name])


_LATEST_FY = "(select max(fiscal_year) from vw_company_fundamentals)"


def _latest_year(indicator: str, actuals: bool) -> str:
    extra = " and is_projection = 'N'" if actuals else ""
    return f"(select max(year) from vw_economic_overview where indicator_name = {_lit(indicator)}{extra})"


def _inventory(order: list[str], count_col: str) -> str:
    branches = " union all ".join(
        f"select {_lit(n)} as object, count(*) as {count_col} from {n}" for n in order
    )
    return with_ctes(branches, order)


def oracle_sql(p: Params = DEFAULT) -> dict[str, str]:
    y = p.as_of_date.year
    end = p.as_of_date
    start = end - _dt.timedelta(days=365 * p.trailing_years)
    trailing_where = f"where l_shipdate >= timestamp '{start.isoformat()}' and l_shipdate < timestamp '{end.isoformat()}'"
    fund = ["vw_company_fundamentals"]
    perf = ["vw_stock_performance"]
    vsb = ["vw_stock_vs_benchmark"]
    eco = ["vw_economic_overview"]
    fei = ["fact_economic_indicators"]
    notebook = ["dim_companies", "dim_sectors", "fact_stock_prices", "fact_sp500_benchmark", "fact_financials",
                "fact_economic_indicators", "vw_company_fundamentals", "vw_stock_performance",
                "vw_stock_vs_benchmark", "vw_economic_overview"]
    script = ["dim_companies", "dim_sectors", "fact_financials", "fact_stock_prices", "fact_sp500_benchmark",
              "fact_economic_indicators", "vw_company_fundamentals", "vw_stock_performance",
              "vw_stock_vs_benchmark", "vw_economic_overview"]
    fund_cols = [
        "calc_revenue_growth_pct", "profit_margin_pct", "calc_return_on_equity_pct", "calc_return_on_assets_pct",
        "earnings_per_share", "pe_ratio", "price_to_revenue", "calc_price_to_book", "calc_debt_to_asset_ratio",
        "debt_to_equity_ratio", "equity_ratio",
    ]
    filters = [
        ("large cap", "market_cap > 1e11"),
        ("mid cap", "market_cap between 1e10 and 1e11"),
        ("small cap", "market_cap < 1e10"),
        ("profitable", "net_income > 0"),
        ("high growth", "revenue_growth_pct > 15"),
        ("high ROE", "return_on_equity_pct > 20"),
        ("highly leveraged", "debt_to_asset_ratio > 0.7"),
        ("dividend payer", "dividend_yield > 0"),
        ("high yield", "dividend_yield > 3"),
        ("low beta", "beta < 0.8"),
        ("high beta", "beta > 1.2"),
        ("undervalued", "trailing_pe < 15"),
        ("high margin", "net_margin_pct > 20"),
    ]
    q = {
        "profiles_normalised": _table("dim_companies"),
        "profiles_quarantine": with_ctes(
            """select ticker, 'profile' as stage, fetch_error as error from raw_profiles where fetch_error is not null
union all
select ticker, 'prices' as stage, 'no price rows' as error from raw_profiles r
  where not exists (select 1 from lineitem where concat('S', cast(l_suppkey as varchar)) = r.ticker)
union all
select ticker, 'statements' as stage, 'no income statement' as error from raw_profiles r
  where not exists (select 1 from lineitem where concat('S', cast(l_suppkey as varchar)) = r.ticker)""",
            ["raw_profiles"],
        ),
        "sector_reference": with_ctes(
            """select coalesce(s.sector_name, c.sector) as sector_name, s.description,
  cast(coalesce(c.companies, 0) as bigint) as companies
from dim_sectors s full join (select sector, count(*) as companies from dim_companies group by sector) c
  on s.sector_name = c.sector""",
            ["dim_sectors", "dim_companies"],
        ),
        "universe_flatten": """select concat('S', cast(s_suppkey as varchar)) as ticker, s_name as company_name, r_name as sector
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
        "prices_with_returns": _table("fact_stock_prices"),
        "prices_trailing_years": "with trail_bars as (\n" + _bars_sql(trailing_where) + "\n)\n"
        + _returns_sql("trail_bars", "ticker"),
        "benchmark_with_returns": _table("fact_sp500_benchmark"),
        "statements_pivot": _table("statement_periods"),
        "financials": _table("fact_financials"),
        "growth_padded": _table(
            "fact_financials_padded",
            "ticker, fiscal_year, revenue, net_income, revenue_growth_pct, net_income_growth_pct",
        ),
        "indicators_long": _table("fact_economic_indicators"),
        "indicators_from_tsv": _table("fact_economic_indicators"),
        "view_company_fundamentals": _table("vw_company_fundamentals"),
        "view_stock_performance": _table("vw_stock_performance"),
        "view_stock_vs_benchmark": _table("vw_stock_vs_benchmark"),
        "view_economic_overview": _table("vw_economic_overview"),
        "q_l01_top_market_cap": with_ctes(
            f"""select ticker, company_name, sector, {R('market_cap / 1e9', 1)} as market_cap_B,
  {R('dividend_yield', 2)} as div_yield_pct, {R('trailing_pe', 1)} as pe, {R('beta', 2)} as beta
from dim_companies order by market_cap desc nulls last, ticker limit 15""",
            ["dim_companies"],
        ),
        "q_l02_sector_distribution": with_ctes(
            f"""select sector, count(*) as companies, {R('avg(market_cap) / 1e9', 1)} as avg_mktcap_B,
  {R('avg(case when dividend_yield > 0 then dividend_yield end)', 2)} as avg_div_yield,
  {R('avg(trailing_pe)', 1)} as avg_pe, {R('avg(beta)', 2)} as avg_beta
from dim_companies group by sector""",
            ["dim_companies"],
        ),
        "q_l03_price_coverage": with_ctes(
            f"""select min(trade_date) as earliest, max(trade_date) as latest, count(distinct ticker) as tickers,
  count(*) as total_rows, {R('count(*) / nullif(count(distinct ticker), 0)', 0)} as avg_days_per_ticker
from fact_stock_prices""",
            ["fact_stock_prices"],
        ),
        "q_l04_benchmark_coverage": with_ctes(
            f"""select min(trade_date) as earliest, max(trade_date) as latest, count(*) as trading_days,
  {R('min(close_price)', 2)} as min_close, {R('max(close_price)', 2)} as max_close
from fact_sp500_benchmark""",
            ["fact_sp500_benchmark"],
        ),
        "q_l05_financials_by_year": with_ctes(
            f"""select fiscal_year, count(distinct ticker) as companies, {R('sum(revenue) / 1e9', 1)} as total_revenue_B,
  {R('avg(net_margin_pct)', 1)} as avg_net_margin
from fact_financials where revenue is not null group by fiscal_year""",
            ["fact_financials"],
        ),
        "q_l06_indicator_coverage": with_ctes(
            """select indicator_name, count(distinct country) as countries, min(year) as from_year, max(year) as to_year,
  cast(sum(case when is_projection = 'N' then 1 else 0 end) as bigint) as actuals,
  cast(sum(case when is_projection = 'Y' then 1 else 0 end) as bigint) as projections
from fact_economic_indicators group by indicator_name""",
            fei,
        ),
        "q_l07_gdp_pair": with_ctes(
            f"""select country, year, value as gdp_growth_pct, is_projection from fact_economic_indicators
where indicator_name = {_lit(p.gdp)} and country in ({_in(p.country_pair)})""",
            fei,
        ),
        "q_l08_top_revenue_latest": with_ctes(
            f"""select ticker, company_name, sector, fiscal_year, {R('revenue / 1e9', 1)} as revenue_B,
  {R('net_margin_pct', 1)} as net_margin_pct, {R('dividend_yield', 2)} as div_yield_pct,
  {R('trailing_pe', 1)} as pe, {R('beta', 2)} as beta
from vw_company_fundamentals where fiscal_year = {_LATEST_FY}
order by revenue desc nulls last, ticker limit 10""",
            fund,
        ),
        "q_l09_stock_last_days": with_ctes(
            f"""select ticker, trade_date, {R('close_price', 2)} as close, volume, {R('daily_return_pct', 2)} as return_pct
from vw_stock_performance where ticker = {_lit(p.ticker)} order by trade_date desc limit 10""",
            perf,
        ),
        "q_l10_stock_vs_index_last_days": with_ctes(
            f"""select ticker, trade_date, {R('close_price', 2)} as stock_close, {R('sp500_close', 2)} as sp500_close,
  {R('stock_daily_return_pct', 2)} as stock_return, {R('sp500_daily_return_pct', 2)} as sp500_return,
  {R('excess_return_pct', 2)} as excess_return
from vw_stock_vs_benchmark where ticker = {_lit(p.ticker)} order by trade_date desc limit 10""",
            vsb,
        ),
        "q_l11_inflation_latest_actual": with_ctes(
            f"""select country, year, {R('value', 2)} as inflation_pct, is_projection from vw_economic_overview
where indicator_name = {_lit(p.inflation)} and year = {_latest_year(p.inflation, True)}""",
            eco,
        ),
        "q_l12_row_inventory": _inventory(notebook, "rows"),
        "q_l13_dividend_coverage": with_ctes(
            f"""select sector, count(*) as total, cast(sum(case when dividend_yield > 0 then 1 else 0 end) as bigint) as payers,
  {R('avg(case when dividend_yield > 0 then dividend_yield end)', 2)} as avg_yield_pct
from dim_companies group by sector""",
            ["dim_companies"],
        ),
        "q_l14_valuation_spread": with_ctes(
            f"""select sector, {R('avg(trailing_pe)', 1)} as avg_pe, {R('avg(price_to_book)', 1)} as avg_pb,
  {R('avg(beta)', 2)} as avg_beta
from dim_companies where trailing_pe > 0 group by sector""",
            ["dim_companies"],
        ),
        "q_l15_high_yield_latest": with_ctes(
            f"""select ticker, company_name, sector, {R('dividend_yield', 2)} as div_yield_pct,
  {R('dividend_rate', 2)} as annual_div_usd, {R('payout_ratio', 1)} as payout_ratio_pct
from vw_company_fundamentals where dividend_yield > 0 and fiscal_year = {_LATEST_FY}
order by dividend_yield desc nulls last, ticker limit 10""",
            fund,
        ),
        "q_l16_low_pe_latest": with_ctes(
            f"""select ticker, company_name, sector, {R('trailing_pe', 1)} as pe, {R('forward_pe', 1)} as fwd_pe,
  {R('price_to_book', 1)} as pb, {R('net_margin_pct', 1)} as margin_pct
from vw_company_fundamentals where trailing_pe > 0 and trailing_pe < 15 and fiscal_year = {_LATEST_FY}""",
            fund,
        ),
        "q_l17_sector_outperformance": with_ctes(
            f"""select sector, {R('avg(stock_daily_return_pct)', 4)} as avg_sector_return,
  {R('avg(sp500_daily_return_pct)', 4)} as avg_sp500_return, {R('avg(excess_return_pct)', 4)} as avg_excess_return,
  count(distinct ticker) as stocks
from vw_stock_vs_benchmark where trade_year = {y} group by sector""",
            vsb,
        ),
        "q_l18_govt_debt_group": with_ctes(
            f"""select country, year, {R('value', 1)} as govt_debt_pct_gdp, is_projection from vw_economic_overview
where indicator_name = {_lit(p.govt_debt)} and country in ({_in(p.country_group)})
  and year = {_latest_year(p.govt_debt, True)}""",
            eco,
        ),
        "q_l19_top_revenue": with_ctes(
            f"""select ticker, company_name, sector, fiscal_year, revenue, net_income, net_margin_pct
from vw_company_fundamentals where fiscal_year = {_LATEST_FY} order by revenue desc nulls last, ticker limit 10""",
            fund,
        ),
        "q_l20_company_revenue_trend": with_ctes(
            f"""select ticker, company_name, fiscal_year, revenue, net_income, revenue_growth_pct, net_margin_pct
from vw_company_fundamentals where ticker = {_lit(p.ticker)}""",
            fund,
        ),
        "q_l21_sector_margin_latest": with_ctes(
            f"""select sector, {R('avg(net_margin_pct)', 2)} as avg_net_margin_pct, {R('avg(return_on_equity_pct)', 2)} as avg_roe_pct,
  count(distinct ticker) as num_companies
from vw_company_fundamentals where fiscal_year = {_LATEST_FY} group by sector""",
            fund,
        ),
        "q_l22_ytd_best": with_ctes(
            f"""select * from (
  select distinct ticker, company_name, sector, {R('((last_price - first_price) / first_price) * 100', 2)} as ytd_return_pct
  from (select ticker, company_name, sector,
          first_value(close_price) over (partition by ticker order by trade_date) as first_price,
          last_value(close_price) over (partition by ticker order by trade_date
            rows between unbounded preceding and unbounded following) as last_price
        from vw_stock_performance where trade_year = {y}) ytd
  where first_price > 0) d
order by ytd_return_pct desc nulls last, ticker limit 10""",
            perf,
        ),
        "q_l23_most_volatile": with_ctes(
            f"""select ticker, company_name, sector, {R('stddev_samp(daily_return_pct)', 4)} as daily_return_stddev,
  {R('min(daily_return_pct)', 2)} as worst_day, {R('max(daily_return_pct)', 2)} as best_day
from vw_stock_performance where trade_year = {y - 1} group by ticker, company_name, sector
order by daily_return_stddev desc nulls last, ticker limit 10""",
            perf,
        ),
        "q_l24_country_gdp_trend": with_ctes(
            f"""select country, year, indicator_name, value from vw_economic_overview
where country = {_lit(p.country)} and indicator_name = {_lit(p.gdp)}""",
            eco,
        ),
        "q_l25_inflation_max_year": with_ctes(
            f"""select country, year, value as inflation_rate_pct from vw_economic_overview
where indicator_name = {_lit(p.inflation)} and year = {_latest_year(p.inflation, False)}""",
            eco,
        ),
        "q_l26_highly_leveraged": with_ctes(
            f"""select ticker, company_name, sector, fiscal_year, debt_to_asset_ratio, total_liabilities, total_assets
from vw_company_fundamentals where fiscal_year = {_LATEST_FY} and debt_to_asset_ratio > 0.7""",
            fund,
        ),
        "q_l27_stock_vs_index_prior_year": with_ctes(
            f"""select ticker, company_name, {R('avg(stock_daily_return_pct)', 4)} as avg_daily_return,
  {R('avg(sp500_daily_return_pct)', 4)} as avg_sp500_return, {R('avg(excess_return_pct)', 4)} as avg_excess_return,
  count(*) as trading_days
from vw_stock_vs_benchmark where ticker = {_lit(p.ticker)} and trade_year = {y - 1} group by ticker, company_name""",
            vsb,
        ),
        "q_l28_highest_dividend": with_ctes(
            f"""select ticker, company_name, sector, {R('dividend_yield', 2)} as dividend_yield_pct,
  {R('dividend_rate', 2)} as annual_dividend_usd, {R('payout_ratio', 1)} as payout_ratio_pct
from vw_company_fundamentals where dividend_yield > 0 and fiscal_year = {_LATEST_FY}
order by dividend_yield desc nulls last, ticker limit 10""",
            fund,
        ),
        "q_ytd_minmax_by": with_ctes(
            f"""select ticker, company_name, sector, {R('((last_price - first_price) / first_price) * 100', 2)} as ytd_return_pct
from (select ticker, company_name, sector, arg_min(close_price, trade_date) as first_price,
        arg_max(close_price, trade_date) as last_price
      from vw_stock_performance where trade_year = {y} group by ticker, company_name, sector) t
where first_price > 0 order by ytd_return_pct desc nulls last, ticker limit 10""",
            perf,
        ),
        "v_rows_and_columns": with_ctes(
            " union all ".join(
                f"select {_lit(n)} as table_name, count(*) as row_count, {c} as column_count from {n}"
                for n, c in [("dim_companies", 18), ("dim_sectors", 2), ("fact_stock_prices", 8),
                             ("fact_sp500_benchmark", 7), ("fact_financials", 28)]
            ),
            ["dim_companies", "dim_sectors", "fact_stock_prices", "fact_sp500_benchmark", "fact_financials"],
        ),
        "v_sector_counts": with_ctes("select sector, count(*) as count from dim_companies group by sector", ["dim_companies"]),
        "v_payers": with_ctes(
            f"""select sector, {R('avg(dividend_yield)', 2)} as avg_dividend_yield_pct, count(*) as dividend_payers
from dim_companies where dividend_yield > 0 group by sector""",
            ["dim_companies"],
        ),
        "v_date_range": with_ctes(
            """select min(trade_date) as earliest_date, max(trade_date) as latest_date, count(distinct ticker) as unique_tickers
from fact_stock_prices""",
            ["fact_stock_prices"],
        ),
        "v_indicator_totals": with_ctes(
            """select count(*) as total_rows, (select count(*) from (select distinct country from fact_economic_indicators) a) as countries,
  (select count(*) from (select distinct indicator_name from fact_economic_indicators) b) as indicators,
  min(year) as min_year, max(year) as max_year
from fact_economic_indicators""",
            fei,
        ),
        "v_country_records": with_ctes(
            """select country, count(*) as records, count(distinct indicator_name) as indicators
from fact_economic_indicators group by country""",
            fei,
        ),
        "v_series_sample": with_ctes(
            f"""select * from fact_economic_indicators
where country = {_lit(p.sample_country)} and indicator_name = {_lit(p.gdp)}""",
            fei,
        ),
        "v_inventory": _inventory(script, "row_count"),
        "m_expr_fundamentals": with_ctes(
            f"""select ticker, fiscal_year,
  {R('((revenue - prev_year_revenue) / nullif(prev_year_revenue, 0)) * 100', 2)} as calc_revenue_growth_pct,
  {R('(net_income / nullif(revenue, 0)) * 100', 2)} as profit_margin_pct,
  {R('(net_income / nullif(stockholders_equity, 0)) * 100', 2)} as calc_return_on_equity_pct,
  {R('(net_income / nullif(total_assets, 0)) * 100', 2)} as calc_return_on_assets_pct,
  eps as earnings_per_share,
  case when net_income > 0 then {R('market_cap / net_income', 2)} else null end as pe_ratio,
  case when revenue > 0 then {R('market_cap / revenue', 2)} else null end as price_to_revenue,
  case when stockholders_equity > 0 then {R('market_cap / stockholders_equity', 2)} else null end as calc_price_to_book,
  {R('total_liabilities / nullif(total_assets, 0)', 2)} as calc_debt_to_asset_ratio,
  case when stockholders_equity > 0 then {R('total_liabilities / stockholders_equity', 2)} else null end as debt_to_equity_ratio,
  {R('stockholders_equity / nullif(total_assets, 0)', 2)} as equity_ratio
from (select *, lag(revenue) over (partition by ticker order by fiscal_year) as prev_year_revenue
      from vw_company_fundamentals) v""",
            fund,
        ),
        "m_expr_prices": with_ctes(
            f"""select ticker, trade_date, daily_return_pct as daily_return, {R('high_price - low_price', 2)} as price_range,
  {R('((high_price - low_price) / nullif(open_price, 0)) * 100', 2)} as price_range_pct
from vw_stock_performance""",
            perf,
        ),
        "m_measures": with_ctes(
            f"""select coalesce(a.sector, b.sector) as sector, a.avg_daily_volume, b.avg_excess_return
from (select sector, avg(volume) as avg_daily_volume from vw_stock_performance group by sector) a
full join (select sector, {R('avg(excess_return_pct)', 4)} as avg_excess_return from vw_stock_vs_benchmark group by sector) b
  on a.sector = b.sector""",
            perf + vsb,
        ),
        "m_filters": with_ctes(
            " union all ".join(
                f"select {_lit(n)} as filter_name, cast(count(*) as bigint) as matched_rows, "
                f"cast(count(distinct ticker) as bigint) as matched_keys from vw_company_fundamentals where {cond}"
                for n, cond in filters
            ),
            fund,
        ),
        "m_run_metric": with_ctes(
            f"""select sector, trade_year, {R('avg(excess_return_pct)', 4)} as avg_excess_return
from vw_stock_vs_benchmark where beta > 1.2 group by sector, trade_year""",
            vsb,
        ),
        "table_roundtrip": _table("dim_companies"),
        "m_synonyms": with_ctes(
            f"""select sector, {R('avg(revenue)', 2)} as avg_revenue, {R('avg(net_income)', 2)} as avg_net_income,
  {R('avg(return_on_equity_pct)', 2)} as avg_return_on_equity_pct, {R('avg(trailing_pe)', 2)} as avg_trailing_pe
from vw_company_fundamentals where net_income > 0 group by sector""",
            fund,
        ),
        "q_latest_sector_outperformance": with_ctes(_outperformance(_LATEST_YEAR), vsb),
        "q_latest_ytd_best": with_ctes(_ytd_best(_LATEST_YEAR), perf + ["fact_sp500_benchmark"]),
        "companies_from_json": with_ctes(_companies_of("json_profiles"), ["json_profiles"]),
        "profiles_rejected": with_ctes(
            """select ticker, 'profile' as stage, fetch_error as error from json_profiles where fetch_error is not null
union all select ticker, 'prices', 'no price rows' from json_profiles
  where ticker not in (select concat('S', cast(l_suppkey as varchar)) from lineitem where l_suppkey is not null)
union all select ticker, 'statements', 'no income statement' from json_profiles
  where ticker not in (select concat('S', cast(l_suppkey as varchar)) from lineitem where l_suppkey is not null)
union all select null, 'landing', case when cut then 'malformed record' else 'no key' end from landed_profiles
  where cut or ticker is null""",
            ["landed_profiles", "json_profiles"],
        ),
        "tickers_without_bars": f"""select concat('S', cast(s_suppkey as varchar)) as ticker, 'prices' as stage, 'no price rows' as error
from supplier where s_suppkey not in (select l_suppkey from lineitem where l_suppkey is not null
  and l_shipdate >= timestamp '{(end - _dt.timedelta(days=3)).isoformat()}' and l_shipdate < timestamp '{end.isoformat()}')""",
        "prices_from_files": _table("fact_stock_prices"),
        "prices_padded": with_ctes(_returns_padded_sql("prices_gappy"), ["prices_gappy"]),
        "index_from_files": _table("fact_sp500_benchmark"),
        "index_repeated_days": with_ctes(
            """select trade_date, cast(2 as bigint) as rows, close_price as lowest_close, close_price + 1 as highest_close
from raw_index where day(trade_date) = 5""",
            ["raw_index"],
        ),
        "index_quarantined": with_ctes(_returns_sql("index_unique", ""), ["index_unique"]),
        "financials_from_files": with_ctes("select * from fact_financials_nan", ["fact_financials_nan"]),
        "statement_conflicts": with_ctes(
            """select ticker, 'income' as statement, period_end, 'Net Income' as line_item, cast(2 as bigint) as rows,
  net_income as lowest, net_income + 1 as highest
from statement_periods where cast(ticker[2:] as bigint) % 4 = 3""",
            ["statement_periods"],
        ),
        "indicators_from_panels": with_ctes(
            "select * from fact_economic_indicators where cast(country_code[2:] as integer) % 2 = 0 or year > 2015", fei
        ),
        "sql_sector_volume": with_ctes(
            """select v.sector, v.trade_year, cast(sum(v.volume) as bigint) as volume, count(distinct c.exchange) as exchanges
from vw_stock_performance v join dim_companies c on v.ticker = c.ticker where v.volume > 0 group by v.sector, v.trade_year""",
            perf + ["dim_companies"],
        ),
        "catalog_comments": _inventory(notebook, "object_rows").replace(
            f"select {_lit(notebook[0])} as object", f"select n.*, i.object_rows from (values {_comment_rows()}) as n(object, column_name, comment) join (select {_lit(notebook[0])} as object", 1
        )
        + ") as i on n.object = i.object",
        "preview_companies": with_ctes("select * from dim_companies order by ticker limit 5", ["dim_companies"]),
        "q_ask_highest_volume_days": with_ctes(
            f"""select ticker, trade_date, volume, {R('close_price', 2)} as close, {R('daily_return_pct', 2)} as return_pct
from vw_stock_performance where ticker = {_lit(p.ticker)}
order by volume desc nulls last, trade_date desc limit 10""",
            perf,
        ),
        "q_ask_top_beta": with_ctes(
            f"""select ticker, company_name, sector, {R('beta', 2)} as beta from dim_companies
order by beta desc nulls last, ticker limit 5""",
            ["dim_companies"],
        ),
        "q_ask_highest_roe": with_ctes(
            f"""select ticker, company_name, sector, fiscal_year, {R('return_on_equity_pct', 2)} as roe_pct
from vw_company_fundamentals where fiscal_year = {_LATEST_FY}
order by return_on_equity_pct desc nulls last, ticker limit 10""",
            fund,
        ),
        "q_ask_sector_revenue_growth": with_ctes(
            f"""select ticker, company_name, fiscal_year, {R('revenue_growth_pct', 2)} as revenue_growth_pct
from vw_company_fundamentals where sector = {_lit(p.sector)} and fiscal_year = {_LATEST_FY}
order by vw_company_fundamentals.revenue_growth_pct desc nulls last, ticker limit 10""",
            fund,
        ),
        "q_ask_low_pe_in_sector": with_ctes(
            f"""select ticker, company_name, {R('trailing_pe', 1)} as pe from dim_companies
where sector = {_lit(p.sector)} and trailing_pe > 0 order by trailing_pe, ticker limit 10""",
            ["dim_companies"],
        ),
        "q_ask_margin_comparison": with_ctes(
            f"""select ticker, company_name, fiscal_year, {R('net_margin_pct', 2)} as net_margin_pct
from vw_company_fundamentals where ticker in ({_in(p.ticker_pair)}) and fiscal_year > {_LATEST_FY} - 5""",
            fund,
        ),
        "q_ask_indicator_forecast": with_ctes(
            f"""select country, year, {R('value', 2)} as gdp_growth_pct, is_projection from vw_economic_overview
where country = {_lit(p.forecast_country)} and indicator_name = {_lit(p.gdp)} and year = {p.forecast_year}""",
            eco,
        ),
        "q_ask_inflation_comparison": with_ctes(
            f"""select country, year, {R('value', 2)} as inflation_pct, is_projection from vw_economic_overview
where indicator_name = {_lit(p.inflation)} and country in ({_in(p.country_trio)})""",
            eco,
        ),
        "q_ask_highest_debt": with_ctes(
            f"""select country, year, {R('value', 1)} as govt_debt_pct_gdp from vw_economic_overview
where indicator_name = {_lit(p.govt_debt)} and year = {_latest_year(p.govt_debt, True)}
order by value desc nulls last, country limit 1""",
            eco,
        ),
        "q_ask_high_yield": with_ctes(
            f"""select ticker, company_name, sector, {R('dividend_yield', 2)} as div_yield_pct
from dim_companies where dividend_yield > 3""",
            ["dim_companies"],
        ),
        "q_ask_best_sector_returns": with_ctes(
            f"""select sector, {R('avg(daily_return_pct)', 4)} as avg_daily_return_pct, count(distinct ticker) as stocks
from vw_stock_performance where trade_year = {y} group by sector""",
            perf,
        ),
        "q_ask_unemployment_trend": with_ctes(
            f"""select country, year, {R('value', 2)} as unemployment_pct from vw_economic_overview
where country = {_lit(p.trend_country)} and indicator_name = {_lit(p.unemployment)} and is_projection = 'N'
  and year > {_latest_year(p.unemployment, True)} - 10""",
            eco,
        ),
    }
    return q
