"""Edge fixtures for the star-schema transforms and views."""

import datetime as dt


from marketstar import schemas
from marketstar.plans import queries as Q
from marketstar.plans import star as K
from marketstar.plans import views as V
from marketstar.sources import universe


def _profile(**kw):
    base = {f.name: None for f in schemas.RAW_PROFILES.fields}
    base.update(kw)
    return tuple(base[f.name] for f in schemas.RAW_PROFILES.fields)


def test_e7_yield_price_fallback(spark):
    rows = [
        _profile(ticker="A", company_name="a", curated_sector="X", dividend_rate=2.0, regular_market_price=50.0),
        _profile(ticker="B", company_name="b", curated_sector="X", dividend_rate=2.0, current_price=0.0),
    ]
    out = {r.ticker: r for r in K.companies(spark.createDataFrame(rows, schemas.RAW_PROFILES)).collect()}
    assert out["A"].dividend_yield == 4.0
    assert out["B"].dividend_yield == 0.0


def test_e9_failed_fetch_gives_default_row_and_quarantine(spark):
    rows = [
        _profile(ticker="A", company_name="a", curated_sector="Energy", sector="Other", market_cap=5.0,
                 beta=1.5, fetch_error="timeout"),
        _profile(ticker="B", company_name="b", curated_sector="Energy", market_cap=None, employees=None),
    ]
    raw = spark.createDataFrame(rows, schemas.RAW_PROFILES)
    out = {r.ticker: r for r in K.companies(raw).collect()}
    a = out["A"]
    assert (a.sector, a.industry, a.headquarters_country, a.exchange, a.currency) == (
        "Energy", "Unknown", "United States", "Unknown", "USD")
    assert a.market_cap == 0.0 and a.employees == 0 and a.beta == 0.0
    b = out["B"]
    assert b.sector == "Energy" and b.market_cap == 0.0 and b.employees == 0
    prices = spark.createDataFrame([("B", dt.date(2000, 1, 3))], "ticker string, trade_date date")
    stmts = spark.createDataFrame([("B", "income")], "ticker string, statement string")
    q = {(r.ticker, r.stage) for r in K.profile_quarantine(raw, prices, stmts).collect()}
    assert q == {("A", "profile"), ("A", "prices"), ("A", "statements")}


def _wide(spark, cells, start="2019", years=("2019", "2020"), country="Korea", code="C1"):
    cols = ["ISO", "Country", "WEO Subject Code", "Estimates Start After", *years]
    rows = [("KOR", country, code, start, *row) for row in cells]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))


SPEC = K.IndicatorSpec(codes={"C1": "Ind one"}, countries=("Korea", "Japan"), renames={"Korea": "South Korea"})


def test_e10_cell_cleaning(spark):
    cells = [("1,234.567", "n/a"), ("--", None), ("abc", "2.0005")]
    wide = _wide(spark, cells, years=("2019", "2020"))
    got = sorted(r.value for r in K.indicators(wide, SPEC).collect())
    assert got == [2.001, 1234.567]


def test_e11_e12_flags_and_renames(spark):
    wide = _wide(spark, [("1", "2")]).unionByName(_wide(spark, [("3", "4")], country="Japan", start=None))
    got = {(r.country, r.year): r.is_projection for r in K.indicators(wide, SPEC).collect()}
    assert got == {("South Korea", 2019): "N", ("South Korea", 2020): "Y", ("Japan", 2019): "N", ("Japan", 2020): "N"}


def test_e13_missing_year_columns(spark):
    wide = _wide(spark, [("1", "2")], years=("2028", "2029"))
    got = sorted(r.year for r in K.indicators(wide, SPEC).collect())
    assert got == [2028, 2029]


def test_filter_drops_other_codes_and_countries(spark):
    wide = _wide(spark, [("1", "2")], code="ZZ").unionByName(_wide(spark, [("1", "2")], country="Peru"))
    assert K.indicators(wide, SPEC).count() == 0


def _stmt(rows):
    return [(t, s, dt.date(y, m, 31 if m == 12 else 30), item, v) for t, s, y, m, item, v in rows]


def test_e14_e15_e17_statement_alignment(spark):
    rows = _stmt([
        ("A", "income", 2000, 12, "Total Revenue", 100.0),
        ("A", "income", 2000, 12, "Net Income", 10.0),
        ("A", "balance", 2000, 12, "Total Assets", 50.0),
        ("A", "balance", 2001, 12, "Total Assets", 70.0),      # balance without income → dropped
        ("B", "income", 2000, 6, "Total Revenue", 10.0),        # two periods in one year
        ("B", "income", 2000, 12, "Total Revenue", 20.0),
        ("B", "income", 2000, 12, "Net Income", float("nan")),  # NaN → NULL
    ])
    raw = spark.createDataFrame(rows, schemas.RAW_STATEMENTS)
    fin = K.financials(raw).orderBy("ticker", "revenue").collect()
    assert [(r.ticker, r.fiscal_year) for r in fin] == [("A", 2000), ("B", 2000), ("B", 2000)]
    a = fin[0]
    assert a.return_on_assets_pct == 20.0 and a.current_ratio is None and a.net_margin_pct == 10.0
    assert fin[1].revenue_growth_pct is None and fin[2].revenue_growth_pct == 100.0
    assert fin[2].net_income is None


def _mini_star(spark, prices_rows, index_rows, companies_rows, fin_rows):
    price_schema = "ticker string, trade_date date, open_price double, high_price double, low_price double, close_price double, volume bigint"
    prices = K.stock_prices(spark.createDataFrame(prices_rows, price_schema))
    index = K.benchmark(spark.createDataFrame(index_rows, ", ".join(price_schema.split(", ")[1:])))
    raw_prof = spark.createDataFrame(companies_rows, schemas.RAW_PROFILES)
    fin = K.financials(spark.createDataFrame(fin_rows, schemas.RAW_STATEMENTS))
    empty_ind = spark.createDataFrame([], ", ".join(f"{n} {t.simpleString()}" for n, t, _ in schemas.FACT_ECONOMIC))
    return K.Star(
        dim_companies=K.companies(raw_prof),
        dim_sectors=universe.sectors(spark),
        fact_stock_prices=prices,
        fact_sp500_benchmark=index,
        fact_financials=fin,
        fact_economic_indicators=empty_ind,
    )


def test_e18_e19_e20_view_joins(spark):
    d1, d2 = dt.date(2000, 1, 3), dt.date(2000, 1, 4)
    prices = [("A", d1, 1.0, 1.0, 1.0, 10.0, 5), ("A", d2, 1.0, 1.0, 1.0, 11.0, 5), ("Z", d1, 1.0, 1.0, 1.0, 3.0, 1)]
    index = [(d1, 1.0, 1.0, 1.0, 100.0, 9)]  # d2 missing from the index
    comps = [_profile(ticker="A", company_name="a", curated_sector="X"),
             _profile(ticker="N", company_name="n", curated_sector="X")]  # N: no filings
    fin = _stmt([("A", "income", 2000, 12, "Total Revenue", 5.0)])
    st = _mini_star(spark, prices, index, comps, fin)
    fund = V.company_fundamentals(st).collect()
    assert sorted((r.ticker, r.fiscal_year) for r in fund) == [("A", 2000), ("N", None)]
    assert {r.ticker for r in Q.l19_top_revenue(st).collect()} == {"A"}
    perf = V.stock_performance(st).collect()
    assert sorted((r.ticker, r.trade_date) for r in perf) == [("A", d1), ("A", d2)]
    vsb = V.stock_vs_benchmark(st).collect()
    assert [(r.ticker, r.trade_date) for r in vsb] == [("A", d1)]


def test_e21_market_cap_filters(spark):
    from marketstar.functions import semantic as S

    df = spark.createDataFrame([("a", 1e10), ("b", 1e11), ("c", 1.5e11), ("d", 9.9e9)], "ticker string, market_cap double")
    got = {r.filter_name: r.matched_rows for r in S.filter_counts(df, ["large cap", "mid cap", "small cap"]).collect()}
    assert got == {"large cap": 1, "mid cap": 2, "small cap": 1}


def test_e22_empty_prices_coverage(spark):
    st = _mini_star(spark, [], [], [], [])
    (row,) = Q.l03_price_coverage(st).collect()
    assert row.total_rows == 0 and row.tickers == 0 and row.avg_days_per_ticker is None
