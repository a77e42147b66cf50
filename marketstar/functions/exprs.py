"""Column-level helpers shared by every table and query.

All helpers return built-in ``Column`` expressions (no Python UDFs), so they
stay inside whole-stage codegen and Catalyst can fold, prune and push them.
"""

from __future__ import annotations

from typing import Iterable, Union

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ColumnOrName = Union[Column, str]


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


#: Places of the decimal text that rounding looks at: enough for any value as written, while the last bits of a
#: double sum, which depend on the order of its rows, do not decide a tie.
_TEXT_PLACES = 12


def R(x: ColumnOrName, n: int) -> Column:
    """Round half-up on the decimal text of ``x``; result stays ``double``.

    ``round`` on a double differs between engines at ties (1.005, 0.125);
    going through the text makes Spark and the SQL oracle agree.  A value
    beyond ``decimal(38,12)`` has no such places: it is rounded as the double
    it is, without an error.
    """
    x = _c(x)
    return F.coalesce(F.round(x.try_cast(f"decimal(38,{_TEXT_PLACES})"), n).cast("double"), F.round(x.cast("double"), n))


def nullif0(x: ColumnOrName) -> Column:
    """``NULLIF(x, 0)``: a zero divisor gives NULL instead of an ANSI error."""
    return F.nullif(_c(x), F.lit(0.0))


def safe_pct(num: ColumnOrName, den: ColumnOrName, places: int = 2) -> Column:
    """``round(num/den*100, 2)``; NULL when either side is NULL or den is 0."""
    return R(_c(num) / nullif0(den) * F.lit(100.0), places)


def safe_ratio(num: ColumnOrName, den: ColumnOrName, places: int = 2) -> Column:
    """``round(num/den, 2)``; NULL when either side is NULL or den is 0."""
    return R(_c(num) / nullif0(den), places)


def falsy_or(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Python ``a or b`` on numbers: NULL *or zero* falls back to ``b``."""
    a = _c(a)
    return F.when(F.coalesce(a, F.lit(0.0)) != 0, a).otherwise(_c(b))


def default(x: ColumnOrName, value) -> Column:
    """NULL → ``value`` (``info.get(k, d)`` / ``... or 0`` on a landed record)."""
    return F.coalesce(_c(x), F.lit(value))


def nan_to_null(x: ColumnOrName) -> Column:
    """NaN → NULL, so it cannot pass ``IS NOT NULL`` or poison ``AVG``."""
    x = _c(x)
    return F.when(~F.isnan(x), x)


def nan_to_null_all(df: DataFrame) -> DataFrame:
    """Apply :func:`nan_to_null` to every ``double``/``float`` column (ingest rule)."""
    return df.select(
        *[
            nan_to_null(f.name).alias(f.name) if f.dataType.typeName() in ("double", "float") else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def dividend_yield(rate: ColumnOrName, price: ColumnOrName) -> Column:
    """Yield in percent of price; 0.0 when the price is missing or not positive."""
    rate, price = _c(rate), _c(price)
    return F.when(price > 0, R(rate / price * F.lit(100.0), 2)).otherwise(F.lit(0.0))


def payout_percent(raw: ColumnOrName) -> Column:
    """Rescale a payout ratio: values ``<= 5`` are fractions (x100), larger are percents."""
    raw = _c(raw)
    return F.when(raw <= 5, R(raw * F.lit(100.0), 2)).otherwise(R(raw, 2))


def projection_flag(year: ColumnOrName, estimates_start: ColumnOrName) -> Column:
    """``'Y'`` strictly after the estimates-start year, else ``'N'`` (NULL start → ``'N'``)."""
    start = _c(estimates_start).try_cast("int")
    return F.when(start.isNotNull() & (_c(year) > start), F.lit("Y")).otherwise(F.lit("N"))


def in_calendar_year(date_col: ColumnOrName, year: ColumnOrName | int) -> Column:
    """``year(d) = y`` written as a closed date range so it reaches the parquet scan.

    ``year`` may be an expression (a year taken from ``current_date()`` folds
    to a constant, one from a scalar subquery is known before the scan).
    """
    y = F.lit(year) if isinstance(year, int) else _c(year)
    d = _c(date_col)
    return (d >= F.make_date(y, F.lit(1), F.lit(1))) & (d <= F.make_date(y, F.lit(12), F.lit(31)))


def with_period_change(
    df: DataFrame,
    value: str,
    out: str,
    partition_by: Iterable[str],
    order_by: Iterable[ColumnOrName],
    pad: bool = False,
    fill_first: float | None = None,
) -> DataFrame:
    """Percent change against the previous row of the same partition.

    ``(x / prev - 1) * 100`` with a zero base giving NULL.  With ``pad`` a
    missing value first takes the last non-null value before it (the
    padding that pandas ``pct_change`` applies by default).  ``fill_first``
    replaces the NULL of the first row (and of zero bases).

    The window is partitioned by ``partition_by``; callers pass a key whose
    groups are bounded (one row per ticker-day, or per ticker-period).
    """
    parts = list(partition_by)
    w = Window.partitionBy(*parts).orderBy(*[_c(o) for o in order_by])
    base = value
    if pad:
        base = f"__{out}_filled"
        df = df.withColumn(
            base,
            F.last(F.col(value), ignorenulls=True).over(
                w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        )
    change = (F.col(base) / nullif0(F.lag(F.col(base)).over(w)) - F.lit(1.0)) * F.lit(100.0)
    if fill_first is not None:
        change = F.coalesce(change, F.lit(float(fill_first)))
    df = df.withColumn(out, change)
    return df.drop(base) if pad else df


def with_calendar_change(df: DataFrame, value: str, out: str, date_col: str, pad: bool = False, fill_first: float | None = None) -> DataFrame:
    """:func:`with_period_change` over one series in the order of its unique dates, without gathering it in one task.

    Years are the ranges: inside one, the previous row comes from a window over
    that year alone; each year's last value goes to the first row of the next
    year that has rows, through one row per year.
    """
    year, base = "__calendar_year", f"__{out}_base"
    df = df.withColumns({year: F.year(date_col), base: _c(value)}).repartition(year)
    inside = Window.partitionBy(year).orderBy(date_col)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    over_years = Window.orderBy(year)  # one row per calendar year
    # a year's last row, whole: with the same columns both sides of the join read one exchange of the series
    row = F.struct(date_col, base, *[c for c in df.columns if c not in (date_col, base)])
    last = F.max(F.when(F.col(base).isNotNull(), row) if pad else row)
    ends = df.groupBy(year).agg(last[base].alias("__end"))
    before = F.last("__end", ignorenulls=pad).over(over_years.rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.select(year, before.alias("__before"))
    joined = df.join(ends, year, "left")
    if pad:
        joined = joined.withColumn(base, F.coalesce(F.last(base, ignorenulls=True).over(so_far), F.col("__before")))
    previous = F.when(F.row_number().over(inside) == 1, F.col("__before")).otherwise(F.lag(base).over(inside))
    change = (F.col(base) / nullif0(previous) - F.lit(1.0)) * F.lit(100.0)
    if fill_first is not None:
        change = F.coalesce(change, F.lit(float(fill_first)))
    return joined.withColumn(out, change).drop(year, base, "__before")
