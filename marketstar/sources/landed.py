"""Landed market records derived from the driver tables.

The reference fetches profiles, daily bars, index bars and statements from
an HTTP service one ticker at a time, and reads a wide indicator file.  Our
build reads *landed* records instead; for the driver data they are derived
deterministically from the TPC-H-style tables:

* a supplier is a listed company (``ticker = 'S' || s_suppkey``),
* its line items give daily OHLCV bars (one bar per supplier and ship day),
* all line items of a day give the market index bar,
* yearly line-item sums give statement line items,
* order totals per nation, priority and year give the wide indicator panel.

The ``k % m`` rules below do not select rows: every row of every input is
processed.  They blank out individual *fields* so the null, zero and
fallback rules of the reference are exercised by real data.

Scale notes (all aggregations use Spark's partial/map-side aggregation):

* bars: one shuffle on ``(supplier, day)``; a hot supplier is spread over
  its days, and a hot day is combined map-side before the exchange.
* index: rolled up from the bars (no second pass over line items); its
  output is bounded by the number of calendar days.
* statements: one shuffle on ``(supplier, year)``.
* indicator panel: orders are pre-aggregated per customer before the join
  with customers, so the join sees at most customers x priorities x years
  rows, never the raw order stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import TableSource

# Fixed values of the landed-record rules (field blanking and statement
# formulas).  They define the test data, not a filter on it.
STATEMENT_OF_ITEM = {
    "Total Revenue": "income",
    "Cost Of Revenue": "income",
    "Gross Profit": "income",
    "Operating Income": "income",
    "EBIT": "income",
    "Net Income": "income",
    "Diluted EPS": "income",
    "Basic EPS": "income",
    "Total Assets": "balance",
    "Total Liabilities Net Minority Interest": "balance",
    "Stockholders Equity": "balance",
    "Cash And Cash Equivalents": "balance",
    "Long Term Debt": "balance",
    "Current Assets": "balance",
    "Current Liabilities": "balance",
    "Operating Cash Flow": "cash_flow",
}

PANEL_YEAR_OFFSET = 20  # order year + 20 → panel year (1995..2001 → 2015..2021)
ESTIMATES_START = "2019"


def _unless(cond: Column, value: Column) -> Column:
    """``value`` except where ``cond`` holds (then NULL)."""
    return F.when(~cond, value)


def raw_profiles(src: TableSource) -> DataFrame:
    """One profile record per supplier (company)."""
    k = F.col("s_suppkey")
    nation = src.nation  # 25 rows at every scale factor
    region = src.region  # 5 rows at every scale factor
    base = src.supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return base.select(
        F.concat(F.lit("S"), k.cast("string")).alias("ticker"),
        F.col("s_name").alias("company_name"),
        F.col("r_name").alias("curated_sector"),
        _unless(k % 11 == 0, F.col("r_name")).alias("sector"),
        _unless(k % 13 == 0, F.col("n_name")).alias("industry"),
        _unless(k % 17 == 0, F.col("n_name")).alias("country"),
        _unless(k % 19 == 0, F.col("s_acctbal") * F.lit(2e7)).alias("market_cap"),
        _unless(k % 7 == 0, (k * 100).cast("bigint")).alias("employees"),
        F.when(k % 2 == 0, F.lit("NYQ")).when(k % 9 != 0, F.lit("NMS")).alias("exchange"),
        _unless(k % 21 == 0, F.lit("USD")).alias("currency"),
        _unless(k % 3 == 0, (k % 50) / F.lit(1e1)).alias("dividend_rate"),
        _unless(k % 7 == 0, F.lit(5e1) + k % 100).alias("current_price"),
        _unless(k % 14 == 0, F.lit(6e1) + k % 90).alias("regular_market_price"),
        F.when(k % 5 == 0, F.lit(12.5)).when(k % 4 != 0, (k % 90) / F.lit(1e2)).alias("payout_ratio"),
        _unless(k % 23 == 0, (k % 40) * F.lit(1.0)).alias("trailing_pe"),
        _unless(k % 16 == 0, (k % 35) * F.lit(1.0)).alias("forward_pe"),
        ((k % 60) / F.lit(1e1)).alias("price_to_book"),
        ((k % 25) / F.lit(1e1)).alias("beta"),
        (F.lit(1e2) + k % 70).alias("fifty_two_week_high"),
        (F.lit(4e1) + k % 30).alias("fifty_two_week_low"),
        F.when(k % 37 == 0, F.lit("timeout")).alias("fetch_error"),
    )


def profile_lines(src: TableSource) -> DataFrame:
    """Profiles as JSON lines with the faults of a real landing: cut lines, a word where a number belongs, no ticker.

    The ``k % m`` rules spoil records, they drop none: every supplier has a line.
    """
    k = F.regexp_extract("ticker", r"S(\d+)", 1).cast("bigint")
    profiles = raw_profiles(src)
    fields = [f for f in profiles.columns if f not in ("ticker", "market_cap")]
    record = F.to_json(
        F.struct(
            F.when(~(k % 10 == 7), F.col("ticker")).alias("ticker"),
            F.when(k % 9 == 5, F.lit("abc")).otherwise(F.col("market_cap").cast("string")).alias("market_cap"),
            *fields,
        )
    )
    return profiles.select(F.when(k % 9 == 4, F.substring(record, F.lit(1), F.length(record) - 3)).otherwise(record).alias("value"))


def index_with_repeats(src_index: DataFrame) -> DataFrame:
    """The index with a second, diverging row for the fifth of each month (a feed that sent a correction)."""
    again = src_index.where(F.dayofmonth("trade_date") == 5).withColumn("close_price", F.col("close_price") + 1)
    return src_index.unionByName(again)


def prices_with_gaps(raw: DataFrame) -> DataFrame:
    """Bars whose close is missing on the days of a month that 7 divides; no row is dropped."""
    return raw.withColumn("close_price", _unless(F.dayofmonth("trade_date") % 7 == 0, F.col("close_price")))


def statements_with_nan(raw: DataFrame) -> DataFrame:
    """Statements whose missing revenue was landed as NaN, the way a feed writes "no figure"."""
    k = F.regexp_extract("ticker", r"S(\d+)", 1).cast("bigint")
    spoilt = (k % 6 == 1) & (F.col("line_item") == "Total Revenue")
    return raw.withColumn("value", F.when(spoilt, F.lit(float("nan"))).otherwise(F.col("value")))


def statements_restated(raw: DataFrame) -> DataFrame:
    """Statements with repeats: some companies' rows landed twice alike, others' net income restated one higher."""
    k = F.regexp_extract("ticker", r"S(\d+)", 1).cast("bigint")
    alike = raw.where(k % 4 == 2)
    restated = raw.where((k % 4 == 3) & (F.col("line_item") == "Net Income")).withColumn("value", F.col("value") + 1)
    return raw.unionByName(alike).unionByName(restated)


def panel_halves(wide: DataFrame, years: tuple[int, ...] | None = None) -> tuple[DataFrame, DataFrame]:
    """The panel as two deliveries: even nations with all years in order, odd ones without the first year and reversed."""
    years = [str(y) for y in (years or PANEL_YEARS)]
    ids = [c for c in wide.columns if c not in years]
    even = F.substring("ISO", 2, 9).cast("int") % 2 == 0
    return wide.where(even).select(*ids, *years), wide.where(~even).select(*reversed(ids), *reversed(years[1:]))


def raw_universe_nested(src: TableSource) -> DataFrame:
    """The ticker universe landed as nested records ``{sector: {ticker: name}}``.

    One record per company (a nested JSON-lines style source), so a record
    never holds more than one listing however large a sector grows.
    """
    region = src.region  # 5 rows at every scale factor
    nation = src.nation  # 25 rows at every scale factor
    base = src.supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    ticker = F.concat(F.lit("S"), F.col("s_suppkey").cast("string"))
    return base.select(
        F.create_map(F.col("r_name"), F.create_map(ticker, F.col("s_name"))).alias("universe")
    )


#: Digits of each field in a packed line key, most significant first: 38 in all.
LINE_KEY_DIGITS = {"l_orderkey": 13, "l_linenumber": 2, "l_partkey": 11, "l_extendedprice": 9, "l_quantity": 3}


def _line_key() -> Column:
    """Total order of line items inside a day as one ``decimal(38,0)``; the line's price and quantity ride along.

    ``(orderkey, linenumber)`` repeats in the driver data; with part, price (in
    cents) and quantity behind them the key is unique, so its minimum and
    maximum are exactly one line each.  A decimal is a fixed-width aggregation
    buffer: ``min``/``max`` of it run as a hash aggregation with map-side
    combine, where a struct would sort every line item.  A value that does not
    fit its digits fails the query instead of changing the order; a line with a
    missing field has no key.
    """
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    parts = {
        "l_orderkey": (F.col("l_orderkey"), F.lit(True)),
        "l_linenumber": (F.col("l_linenumber").cast("bigint"), F.lit(True)),
        "l_partkey": (F.col("l_partkey"), F.lit(True)),
        "l_extendedprice": (cents, cents / F.lit(100.0) == F.col("l_extendedprice")),
        "l_quantity": (F.col("l_quantity").cast("bigint"), F.floor("l_quantity") == F.col("l_quantity")),
    }
    fits = F.lit(True)
    for name, digits in LINE_KEY_DIGITS.items():
        value, exact = parts[name]
        fits = fits & exact & value.between(0, 10**digits - 1)
    # neighbours that fit a long together are put together as longs; only then come two steps of decimals
    width = LINE_KEY_DIGITS
    high = parts["l_orderkey"][0] * 10 ** width["l_linenumber"] + parts["l_linenumber"][0]
    low = parts["l_extendedprice"][0] * 10 ** width["l_quantity"] + parts["l_quantity"][0]
    n_low = width["l_extendedprice"] + width["l_quantity"]
    n_part = width["l_partkey"]

    def shifted(value: Column, digits: int, by: int) -> Column:
        return value.cast(f"decimal({digits},0)") * F.lit(str(10**by)).cast(f"decimal({by + 1},0)")

    key = shifted(high, width["l_orderkey"] + width["l_linenumber"], n_part + n_low) + (shifted(parts["l_partkey"][0], n_part, n_low) + low.cast(f"decimal({n_low},0)"))
    key = key.cast("decimal(38,0)")
    wrong = F.raise_error(F.concat(F.lit("line item does not fit the packed line key: "), F.to_json(F.struct(*LINE_KEY_DIGITS))))
    return F.when(fits, key).when(~fits, wrong.cast("decimal(38,0)"))


def _line_price(key: str) -> Column:
    """Unit price of the line in a packed key: price over quantity, NULL for no quantity."""
    quantity = 10 ** LINE_KEY_DIGITS["l_quantity"]
    tail = (F.col(key) % F.lit(quantity * 10 ** LINE_KEY_DIGITS["l_extendedprice"])).cast("bigint")
    return F.floor(tail / quantity) / F.lit(100.0) / F.nullif((tail % quantity).cast("double"), F.lit(0.0))


def daily_bars(src: TableSource, start: Column | str | None = None, end: Column | str | None = None) -> DataFrame:
    """OHLCV per supplier and ship day, plus the first/last line keys.

    ``start``/``end`` (ISO dates or foldable date expressions, end exclusive)
    filter ``l_shipdate`` itself so the range reaches the parquet scan as a
    pushed filter.
    """
    # A bar needs a listing; an explicit key check also lets Catalyst fold the
    # null test it infers for the derived ticker, and reaches the scan.
    li = src.lineitem.where(F.col("l_suppkey").isNotNull())
    day = lambda d: (F.lit(d) if isinstance(d, str) else d).cast("timestamp_ntz")
    if start is not None:
        li = li.where(F.col("l_shipdate") >= day(start))
    if end is not None:
        li = li.where(F.col("l_shipdate") < day(end))
    return _bars_of(li)


def _bars_of(li: DataFrame, *more_keys: str) -> DataFrame:
    """The bars of listed line items; ``more_keys`` are columns that the supplier decides."""
    unit = F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0))
    lines = li.select(*more_keys, "l_suppkey", F.to_date("l_shipdate").alias("trade_date"), "l_quantity", "l_extendedprice", unit.alias("unit"), _line_key().alias("line"))
    bars = (
        lines.groupBy(*more_keys, "l_suppkey", "trade_date")
        .agg(
            F.min("line").alias("first_line"),
            F.max("unit").alias("high_price"),
            F.min("unit").alias("low_price"),
            F.max("line").alias("last_line"),
            F.sum("l_quantity").cast("bigint").alias("volume"),
            # Additive day totals, so yearly statements roll up from the bars
            # instead of scanning the line items a second time.
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("day_revenue"),
            F.sum("l_quantity").alias("day_quantity"),
            F.count(F.lit(1)).alias("day_lines"),
        )
    )
    return bars.drop(*more_keys).withColumn("ticker", _ticker())


def _ticker() -> Column:
    return F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))


def daily_bars_by_ticker(src: TableSource, parts: int, most_lines: int) -> DataFrame:
    """:func:`daily_bars` in ``parts`` partitions by ticker, the line items exchanged once.

    Most (supplier, day) groups hold one line item, so combining them before
    the exchange reduces nothing and keeps a whole scan task in memory: the
    lines go to their ticker's partition as they are and are summed there.  A
    supplier of more than ``most_lines`` would be one long task; its lines are
    spread and combined by day, and only its bars go to the ticker's partition.
    """
    li = src.lineitem.where(F.col("l_suppkey").isNotNull())
    counts = li.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    hot = counts.where(F.col("n") > most_lines)  # one in ``most_lines`` rows at most
    columns = ["l_suppkey", "l_shipdate", *[c for c in LINE_KEY_DIGITS]]
    by_ticker = lambda li: _bars_of(li.select(_ticker().alias("__ticker"), *columns).repartition(parts, "__ticker"), "__ticker")
    if not hot.count():
        return by_ticker(li)
    is_hot = F.array_contains(hot.agg(F.collect_list("l_suppkey")).scalar(), F.col("l_suppkey"))
    return by_ticker(li.where(~is_hot)).unionByName(_bars_of(li.where(is_hot)).repartition(parts, "ticker"))


def prices_from_bars(bars: DataFrame) -> DataFrame:
    return bars.select(
        "ticker",
        "trade_date",
        _line_price("first_line").alias("open_price"),
        "high_price",
        "low_price",
        _line_price("last_line").alias("close_price"),
        "volume",
    )


def index_from_bars(bars: DataFrame) -> DataFrame:
    """Market bar per day, rolled up from the supplier bars.

    The first line of a day is the smallest first line over suppliers (same
    for last/max), so this equals a direct aggregation of all line items.
    """
    days = bars.groupBy("trade_date").agg(
        F.min("first_line").alias("first_line"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.max("last_line").alias("last_line"),
        # Cast the day's total once (summing per-supplier truncated volumes
        # would only be exact for whole quantities).
        F.sum("day_quantity").cast("bigint").alias("volume"),
    )
    return days.select("trade_date", _line_price("first_line").alias("open_price"), "high_price", "low_price", _line_price("last_line").alias("close_price"), "volume")


def raw_prices(src: TableSource, start: Column | str | None = None, end: Column | str | None = None) -> DataFrame:
    return prices_from_bars(daily_bars(src, start, end))


def raw_index(src: TableSource, start: Column | str | None = None, end: Column | str | None = None) -> DataFrame:
    return index_from_bars(daily_bars(src, start, end))


def statement_base(bars: DataFrame) -> DataFrame:
    """Yearly totals per supplier, rolled up from the daily bars.

    Revenue is an exact decimal sum and quantities/line counts are exact
    sums, so rolling days up to years equals aggregating the line items
    directly, at the cost of one small aggregation over the bars.
    """
    # the ticker is the supplier's; as a key it lets bars that are bucketed by it be summed where they are
    return bars.groupBy("ticker", F.col("l_suppkey").alias("k"), F.year("trade_date").alias("y")).agg(
        F.sum("day_revenue").cast("double").alias("rev"),
        F.sum("day_quantity").alias("qty"),
        F.sum("day_lines").alias("n"),
    )


def raw_statements(src: TableSource, bars: DataFrame | None = None) -> DataFrame:
    """Long statement rows ``(ticker, statement, period_end, line_item, value)``."""
    return statements_from_base(statement_base(bars if bars is not None else daily_bars(src)))


def statements_from_base(base: DataFrame) -> DataFrame:
    """The 16 line items of each (supplier, year) as long rows; NULL items are not landed."""
    k, y = F.col("k"), F.col("y")
    rev, qty, n = F.col("rev"), F.col("qty"), F.col("n")
    ni = rev - qty * (F.lit(14e2) + (k % 4) * F.lit(1e3))
    items = {
        "Total Revenue": F.when(~((k % 29 == 0) & (y % 3 == 0)), rev),
        "Cost Of Revenue": qty * F.lit(11e2),
        "Gross Profit": rev - qty * F.lit(11e2),
        "Operating Income": F.when(k % 10 == 0, F.lit(0.0)).when(k % 9 != 0, rev - qty * F.lit(125e1)),
        "EBIT": rev - qty * F.lit(124e1),
        "Net Income": ni,
        "Diluted EPS": F.when(k % 8 == 0, F.lit(0.0)).otherwise(ni / F.lit(1e6)),
        "Basic EPS": ni / F.lit(9e5),
        "Total Assets": rev * F.lit(2.0),
        "Total Liabilities Net Minority Interest": rev * (F.lit(1.2) + (k % 5) / F.lit(1e1)) + n * F.lit(1e3),
        "Stockholders Equity": F.when(k % 31 == 0, F.lit(0.0)).otherwise(rev * F.lit(0.7) - n * F.lit(1e3)),
        "Cash And Cash Equivalents": qty * F.lit(1e2),
        "Long Term Debt": qty * F.lit(3e2),
        "Current Assets": rev * F.lit(0.5),
        "Current Liabilities": qty * F.lit(4e2),
        "Operating Cash Flow": rev - qty * F.lit(13e2),
    }
    wide = base.select(
        "ticker",
        F.make_date(y, F.lit(12), F.lit(31)).alias("period_end"),
        *[c.cast("double").alias(name) for name, c in items.items()],
    )
    long = wide.unpivot(["ticker", "period_end"], list(items), "line_item", "value")
    statement = F.create_map(*[F.lit(x) for kv in STATEMENT_OF_ITEM.items() for x in kv])
    return long.where(F.col("value").isNotNull()).select(
        "ticker",
        statement[F.col("line_item")].alias("statement"),
        "period_end",
        "line_item",
        "value",
    )


#: Year columns of the driver panel: order years 1995 to 2001, shifted.
PANEL_YEARS = tuple(range(2015, 2022))


def raw_indicator_panel(src: TableSource, years: tuple[int, ...] = PANEL_YEARS) -> DataFrame:
    """Wide, all-string indicator panel: one row per nation and priority code.

    Columns ``ISO, Country, WEO Subject Code, Estimates Start After`` and
    one string column per year; cells carry thousands separators, the
    sentinels ``n/a`` and ``--``, or nothing.  An order of a year outside
    ``years`` fails the query: a panel without its column would lose it.
    """
    orders = src.orders.select(
        "o_custkey",
        F.col("o_orderpriority").alias("code"),
        (F.year("o_orderdate") + PANEL_YEAR_OFFSET).alias("y"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("tp"),
    )
    # Pre-aggregate the order stream per customer before the customer join.
    per_customer = orders.groupBy("o_custkey", "code", "y").agg(F.sum("tp").alias("tp"))
    per_nation = (
        per_customer.join(
            src.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
        )
        .groupBy(F.col("c_nationkey").alias("nk"), "code", "y")
        .agg(F.sum("tp").alias("tp"))
        .join(src.nation.select("n_nationkey", "n_name"), F.col("nk") == F.col("n_nationkey"))
    )
    v = F.col("tp").cast("double") / F.lit(1e3)
    ky = F.col("nk") + F.col("y")
    cell = (
        F.when(ky % 17 == 0, F.lit(None).cast("string"))
        .when(ky % 13 == 0, F.lit("--"))
        .when(ky % 11 == 0, F.lit("n/a"))
        .otherwise(F.format_number(v, 3))
    )
    outside = F.raise_error(F.concat(F.lit("indicator panel has no column for year "), F.col("y").cast("string")))
    year = F.when(F.col("y").isNull() | F.col("y").isin(*years), F.col("y")).otherwise(outside.cast("int"))
    columns = [str(y) for y in years]
    wide = (
        per_nation.select("nk", "n_name", "code", year.cast("string").alias("y"), cell.alias("cell"))
        .groupBy("nk", "n_name", "code")
        .pivot("y", columns)
        .agg(F.first("cell"))
    )
    est = F.when(~((F.col("nk") % 6 == 0) & (F.col("code") == "5-LOW")), F.lit(ESTIMATES_START))
    return wide.select(
        F.concat(F.lit("C"), F.col("nk").cast("string")).alias("ISO"),
        F.col("n_name").alias("Country"),
        F.col("code").alias("WEO Subject Code"),
        est.alias("Estimates Start After"),
        *[F.col(y) for y in columns],
    )
