"""Named metrics and filters that apply to any view holding their columns.

Three kinds, as in the reference's catalogue:

* expressions — row-level ``Column`` definitions (``withColumns``),
* measures    — aggregate ``Column`` definitions (``groupBy().agg``),
* filters     — boolean ``Column`` definitions (``where``).

Each entry lists the view columns it needs, so it can be checked against a
view's schema before a plan is built.  Names that would shadow a view column
carry a ``calc_`` prefix (the view keeps its stored value).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .exprs import R, nullif0


@dataclass(frozen=True)
class Metric:
    name: str
    kind: str  # "expr" | "measure" | "filter"
    needs: tuple
    build: Callable[[], Column]

    def column(self) -> Column:
        return self.build()


def _c(n: str) -> Column:
    return F.col(n)


def _pct(num: str, den: str) -> Callable[[], Column]:
    return lambda: R(_c(num) / nullif0(den) * F.lit(100.0), 2)


def _guarded_ratio(num: str, den: str) -> Callable[[], Column]:
    return lambda: F.when(_c(den) > 0, R(_c(num) / _c(den), 2))


EXPRESSIONS = [
    Metric(
        "calc_revenue_growth_pct",
        "expr",
        ("revenue", "prev_year_revenue"),
        lambda: R((_c("revenue") - _c("prev_year_revenue")) / nullif0("prev_year_revenue") * F.lit(100.0), 2),
    ),
    Metric("profit_margin_pct", "expr", ("net_income", "revenue"), _pct("net_income", "revenue")),
    Metric("calc_return_on_equity_pct", "expr", ("net_income", "stockholders_equity"), _pct("net_income", "stockholders_equity")),
    Metric("calc_return_on_assets_pct", "expr", ("net_income", "total_assets"), _pct("net_income", "total_assets")),
    Metric("earnings_per_share", "expr", ("eps",), lambda: _c("eps")),
    Metric("pe_ratio", "expr", ("market_cap", "net_income"), _guarded_ratio("market_cap", "net_income")),
    Metric("price_to_revenue", "expr", ("market_cap", "revenue"), _guarded_ratio("market_cap", "revenue")),
    Metric("calc_price_to_book", "expr", ("market_cap", "stockholders_equity"), _guarded_ratio("market_cap", "stockholders_equity")),
    Metric(
        "calc_debt_to_asset_ratio",
        "expr",
        ("total_liabilities", "total_assets"),
        lambda: R(_c("total_liabilities") / nullif0("total_assets"), 2),
    ),
    Metric(
        "debt_to_equity_ratio",
        "expr",
        ("total_liabilities", "stockholders_equity"),
        _guarded_ratio("total_liabilities", "stockholders_equity"),
    ),
    Metric(
        "equity_ratio",
        "expr",
        ("stockholders_equity", "total_assets"),
        lambda: R(_c("stockholders_equity") / nullif0("total_assets"), 2),
    ),
    Metric("daily_return", "expr", ("daily_return_pct",), lambda: _c("daily_return_pct")),
    Metric("price_range", "expr", ("high_price", "low_price"), lambda: R(_c("high_price") - _c("low_price"), 2)),
    Metric(
        "price_range_pct",
        "expr",
        ("high_price", "low_price", "open_price"),
        lambda: R((_c("high_price") - _c("low_price")) / nullif0("open_price") * F.lit(100.0), 2),
    ),
]

MEASURES = [
    Metric("avg_daily_volume", "measure", ("volume",), lambda: F.avg("volume")),
    Metric("avg_excess_return", "measure", ("excess_return_pct",), lambda: R(F.avg("excess_return_pct"), 4)),
]

# Thresholds of the reference's named filters.
FILTERS = [
    Metric("large cap", "filter", ("market_cap",), lambda: _c("market_cap") > 1e11),
    Metric("mid cap", "filter", ("market_cap",), lambda: _c("market_cap").between(1e10, 1e11)),
    Metric("small cap", "filter", ("market_cap",), lambda: _c("market_cap") < 1e10),
    Metric("profitable", "filter", ("net_income",), lambda: _c("net_income") > 0),
    Metric("high growth", "filter", ("revenue_growth_pct",), lambda: _c("revenue_growth_pct") > 15),
    Metric("high ROE", "filter", ("return_on_equity_pct",), lambda: _c("return_on_equity_pct") > 20),
    Metric("highly leveraged", "filter", ("debt_to_asset_ratio",), lambda: _c("debt_to_asset_ratio") > 0.7),
    Metric("dividend payer", "filter", ("dividend_yield",), lambda: _c("dividend_yield") > 0),
    Metric("high yield", "filter", ("dividend_yield",), lambda: _c("dividend_yield") > 3),
    Metric("low beta", "filter", ("beta",), lambda: _c("beta") < 0.8),
    Metric("high beta", "filter", ("beta",), lambda: _c("beta") > 1.2),
    Metric("undervalued", "filter", ("trailing_pe",), lambda: _c("trailing_pe") < 15),
    Metric("high margin", "filter", ("net_margin_pct",), lambda: _c("net_margin_pct") > 20),
]

REGISTRY = {m.name: m for m in EXPRESSIONS + MEASURES + FILTERS}

# Business synonyms → column names.
SYNONYMS = {
    "top line": "revenue",
    "sales": "revenue",
    "bottom line": "net_income",
    "earnings": "net_income",
    "pe ratio": "trailing_pe",
    "p/e": "trailing_pe",
    "pb ratio": "price_to_book",
    "p/b": "price_to_book",
    "roe": "return_on_equity_pct",
    "roa": "return_on_assets_pct",
    "leverage": "debt_to_asset_ratio",
    "dividend yield": "dividend_yield",
    "payout ratio": "payout_ratio",
    "alpha": "excess_return_pct",
    "excess return": "excess_return_pct",
    "beta": "beta",
    "revenue growth": "revenue_growth_pct",
}

# Fixed value: results round money and percentages to two places.
RESULT_PLACES = 2


def resolve(term: str) -> str:
    """Map a business term (any case) to its column name; unknown terms pass through."""
    return SYNONYMS.get(term.strip().lower(), term)


def get(name: str, kind: str | None = None) -> Metric:
    m = REGISTRY[name]
    if kind is not None and m.kind != kind:
        raise KeyError(f"{name!r} is a {m.kind}, not a {kind}")
    return m


def check(view: DataFrame, metrics: Iterable[Metric]) -> None:
    """Fail early when a metric needs a column the view lacks."""
    have = set(view.columns)
    for m in metrics:
        missing = [c for c in m.needs if c not in have]
        if missing:
            raise ValueError(f"metric {m.name!r} needs {missing} which the view does not have")


def with_prev_year_revenue(view: DataFrame) -> DataFrame:
    """``prev_year_revenue``: the ticker's revenue of the previous period (of the previous fiscal year row in a view
    without ``period_end``; two periods of one year are then ordered by their revenue)."""
    order = ["period_end"] if "period_end" in view.columns else ["fiscal_year", "revenue"]
    w = Window.partitionBy("ticker").orderBy(*order)
    return view.withColumn("prev_year_revenue", F.lag("revenue").over(w))


def apply_expressions(view: DataFrame, names: Sequence[str]) -> DataFrame:
    ms = [get(n, "expr") for n in names]
    if any("prev_year_revenue" in m.needs for m in ms) and "prev_year_revenue" not in view.columns:
        view = with_prev_year_revenue(view)
    check(view, ms)
    return view.withColumns({m.name: m.column() for m in ms})


def filter_condition(names: Sequence[str]) -> Column | None:
    cond = None
    for n in names:
        c = get(n, "filter").column()
        cond = c if cond is None else cond & c
    return cond


def present(df: DataFrame, places: int = RESULT_PLACES) -> DataFrame:
    """Round every ``double`` column for display."""
    return df.select(
        *[R(f.name, places).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in df.schema]
    )


def run_metric(
    view: DataFrame,
    dims: Sequence[str] = (),
    measures: Sequence[str] = (),
    filters: Sequence[str] = (),
    expressions: Sequence[str] = (),
) -> DataFrame:
    """``view.withColumns(exprs).where(all filters).groupBy(dims).agg(measures)``.

    Expressions come first: one that looks at a neighbouring row (the previous
    period) must see the rows that the filters drop.  Every name may be a
    business term (``resolve``); a measure named by a plain column is its
    average.  With no measures the filtered, extended rows come back
    unaggregated.
    """
    dims = [resolve(d) for d in dims]
    filters = [resolve(n) for n in filters]
    fs = [get(n, "filter") for n in filters]
    check(view, fs)
    out = apply_expressions(view, [resolve(n) for n in expressions]) if expressions else view
    cond = filter_condition(filters)
    out = out.where(cond) if cond is not None else out
    if not measures:
        return out
    aggregates = []
    for name in map(resolve, measures):
        if name in REGISTRY:
            m = get(name, "measure")
            check(out, [m])
            aggregates.append(m.column().alias(m.name))
        elif name in out.columns:
            aggregates.append(F.avg(name).alias(f"avg_{name}"))
        else:
            raise ValueError(f"unknown measure {name!r}")
    return out.groupBy(*dims).agg(*aggregates)


def filter_counts(view: DataFrame, names: Sequence[str], key: str = "ticker") -> DataFrame:
    """Rows and distinct keys matched by each named filter, in one pass.

    Rows are reduced to one per key first, holding how many of the key's rows
    each filter matches (a hash aggregation with map-side combine, no row is
    multiplied); a second, global one sums the counts and counts the keys that
    have any, so distinct counts are exact.  A NULL key counts rows only.
    """
    ms = [get(n, "filter") for n in names]
    check(view, ms)
    slots = [f"__f{i}" for i in range(len(ms))]
    per_key = view.groupBy(key).agg(*[F.count_if(m.column()).alias(s) for m, s in zip(ms, slots)])
    totals = per_key.agg(
        *[F.coalesce(F.sum(s), F.lit(0)).cast("bigint").alias(f"{s}_rows") for s in slots],
        *[F.count_if((F.col(s) > 0) & F.col(key).isNotNull()).alias(f"{s}_keys") for s in slots],
    )
    both = totals.select(*[F.struct(F.col(f"{s}_rows").alias("matched_rows"), F.col(f"{s}_keys").alias("matched_keys")).alias(n) for n, s in zip(names, slots)])
    return both.unpivot([], list(names), "filter_name", "counts").select("filter_name", "counts.*")
