"""Reshape operators: wide year panel → long rows, long statements → wide periods."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def present_columns(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    """The wanted columns that the frame actually has, in wanted order."""
    have = set(df.columns)
    return [c for c in wanted if c in have]


def unpivot_years(
    df: DataFrame,
    ids: Sequence[str],
    years: Iterable[str],
    variable: str = "year_str",
    value: str = "value_str",
) -> DataFrame:
    """Melt the year columns that exist into ``(variable, value)`` rows.

    Like ``stack``, NULL cells are kept (the caller filters sentinels).
    Missing year columns are skipped instead of failing.
    """
    cols = present_columns(df, years)
    if not cols:
        raise ValueError("none of the requested year columns is present")
    return df.unpivot(list(ids), cols, variable, value)


def pivot_periods(
    long: DataFrame,
    keys: Sequence[str],
    item_col: str,
    value_col: str,
    items: dict[str, str],
    group_col: str | None = None,
    groups: dict[str, str] | None = None,
    anchor: tuple[str, str] | None = None,
) -> DataFrame:
    """Long ``(keys, item, value)`` rows → one row per key with one column per item.

    ``items`` maps a line-item label to its output column.  Written as one
    conditional aggregation (what ``pivot`` with a value list compiles to),
    so there is no extra job to discover pivot values and all columns come
    out of one partial + final hash aggregation on ``keys``.

    With ``group_col`` a label counts only in the group that ``groups`` names
    for it (a line item in its own statement).

    Several values for one cell give the highest; ``quality.conflicting_values``
    reports them.

    ``anchor=(column, value)`` keeps only keys that have at least one row
    with ``column == value`` (align every statement on the income periods).
    """
    def hit(label: str):
        same = F.col(item_col) == F.lit(label)
        return same if group_col is None else same & (F.col(group_col) == F.lit(groups[label]))

    aggs = [F.max(F.when(hit(label), F.col(value_col))).alias(out) for label, out in items.items()]
    if anchor is not None:
        col, val = anchor
        aggs.append(F.max((F.col(col) == F.lit(val)).cast("int")).alias("__anchored"))
    wide = long.groupBy(*keys).agg(*aggs)
    if anchor is not None:
        wide = wide.where(F.col("__anchored") == 1).drop("__anchored")
    return wide
