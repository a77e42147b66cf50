"""Coverage and quarantine operators (missing keys, failed records, inventories)."""

from __future__ import annotations

from functools import reduce
from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_keys(universe: DataFrame, loaded: DataFrame, key: str, stage: str, reason: str) -> DataFrame:
    """Keys of ``universe`` with no row in ``loaded`` → ``(key, stage, error)``.

    ``loaded`` is reduced to its distinct keys first (partial aggregation),
    so only one row per key crosses the shuffle of the anti join.
    """
    present = loaded.select(key).distinct()
    return universe.select(key).join(present, key, "left_anti").select(
        key, F.lit(stage).alias("stage"), F.lit(reason).alias("error")
    )


def quarantined(records: DataFrame, key: str, error_col: str, stage: str) -> DataFrame:
    """Records that carry an error text → ``(key, stage, error)``."""
    return records.where(F.col(error_col).isNotNull()).select(
        key, F.lit(stage).alias("stage"), F.col(error_col).alias("error")
    )


def conflicting_values(long: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys that several rows give *different* values: ``(keys, rows, lowest, highest)``.

    Repeated rows of one value agree and are not reported.  One hash
    aggregation with map-side combine, whatever the number of repeats.
    """
    per_key = long.where(F.col(value).isNotNull()).groupBy(*keys)
    found = per_key.agg(F.count(F.lit(1)).alias("rows"), F.min(value).alias("lowest"), F.max(value).alias("highest"))
    return found.where(F.col("lowest") < F.col("highest"))


def row_inventory(objects: Mapping[str, DataFrame], name_col: str = "object", count_col: str = "rows") -> DataFrame:
    """``SELECT 'name', COUNT(*) ... UNION ALL ...`` over named frames, in order."""
    parts = [
        df.agg(F.count(F.lit(1)).alias(count_col)).select(F.lit(name).alias(name_col), count_col)
        for name, df in objects.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def distinct_count_with_null(col: str):
    """``select(col).distinct().count()`` as one aggregate: NULL counts as a value."""
    return F.count_distinct(F.col(col)) + F.max(F.col(col).isNull().cast("int"))
