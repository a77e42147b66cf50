"""Small literal inputs: the sector reference and a nested ticker universe."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The eleven sector labels of the reference list.
SECTOR_NAMES = (
    "Technology",
    "Healthcare",
    "Financials",
    "Consumer Discretionary",
    "Consumer Staples",
    "Energy",
    "Industrials",
    "Materials",
    "Real Estate",
    "Utilities",
    "Communication Services",
)
SECTORS = [(name, f"Listed companies whose main business is {name.lower()}") for name in SECTOR_NAMES]

SECTOR_SCHEMA = T.StructType(
    [
        T.StructField("sector_name", T.StringType(), False),
        T.StructField("description", T.StringType(), True),
    ]
)


def literal_rows(spark: SparkSession, rows, names) -> DataFrame:
    """Small literal rows built on the JVM (``inline`` of a literal array).

    Unlike ``createDataFrame`` from Python objects this needs no Python
    worker, and the rows fold into the plan as constants.
    """
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def sectors(spark: SparkSession) -> DataFrame:
    """``dim_sectors``: literal rows; ``sector_name`` is never NULL."""
    return literal_rows(spark, SECTORS, [f.name for f in SECTOR_SCHEMA.fields])


def flatten_universe_column(df: DataFrame, col: str = "universe") -> DataFrame:
    """Rows holding ``map<sector, map<ticker, name>>`` → ``(ticker, company_name, sector)``.

    Two ``explode`` generators, evaluated per row on the executors; the
    output of one record is bounded by the size of that record.
    """
    by_sector = df.select(F.explode(col).alias("sector", "members"))
    return by_sector.select("sector", F.explode("members").alias("ticker", "company_name")).select(
        "ticker", "company_name", "sector"
    )


def flatten_universe(spark: SparkSession, nested: dict[str, dict[str, str]]) -> DataFrame:
    """Flatten a literal ``{sector: {ticker: name}}`` mapping (one literal map row)."""
    outer = F.create_map(
        *[
            x
            for sector, members in nested.items()
            for x in (
                F.lit(sector),
                F.create_map(*[F.lit(v) for kv in members.items() for v in kv])
                if members
                else F.create_map().cast("map<string,string>"),
            )
        ]
    )
    return flatten_universe_column(spark.range(1).select(outer.alias("universe")))
