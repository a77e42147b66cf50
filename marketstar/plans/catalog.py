"""Sinks and metadata: full-overwrite tables, comments, schemas, views.

Tables are replaced in full on each load, as in the reference.  Overwriting
a table drops its column comments, so comments are applied after every
write.  Comment text is passed as an escaped SQL string literal, so quotes
in the text are safe.
"""

from __future__ import annotations

import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from .star import Star
from .views import FUNDAMENTALS_COMPANY_COLS, FUNDAMENTALS_FACT_COLS


def quote_identifier(name: str) -> str:
    """Backtick-quote one identifier part, doubling embedded backticks."""
    return "`" + name.replace("`", "``") + "`"


def qualified(*parts: str) -> str:
    return ".".join(quote_identifier(p) for p in parts if p)


def sql_string(text: str) -> str:
    """A Spark SQL string literal for ``text`` (backslash and quote escaped)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def use_schema(spark: SparkSession, schema: str, create: bool = True) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` then ``USE SCHEMA IDENTIFIER(:name)``."""
    if create:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quote_identifier(schema)}")
    spark.sql("USE SCHEMA IDENTIFIER(:name)", args={"name": schema})


@contextmanager
def using_schema(spark: SparkSession, schema: str):
    """``use_schema`` for a while: afterwards the caller's current schema is current again."""
    before = spark.catalog.currentDatabase()
    use_schema(spark, schema)
    try:
        yield
    finally:
        use_schema(spark, before, create=False)


def write_table(
    df: DataFrame,
    table: str,
    partition_by: list[str] | None = None,
    location: str | None = None,
    buckets: tuple[int, list[str]] | None = None,
) -> None:
    """Full overwrite of a catalog table (schema replaced with the new one).

    ``location`` makes it an external table at that path (shared storage);
    ``buckets`` is a number of buckets and the columns that sort them, the
    first of which they are cut by.
    """
    w = df.write.mode("overwrite").option("overwriteSchema", "true")
    if location:
        w = w.option("path", location)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if buckets:
        n, columns = buckets
        w = w.bucketBy(n, columns[0]).sortBy(*columns)
    w.saveAsTable(table)


#: Schema of the tables that the library writes for itself.
SCRATCH_SCHEMA = "marketstar_scratch"


#: Landed rows a bucket is meant for: one task sorts a bucket in memory, with its neighbours on the executor.
ROWS_PER_BUCKET = 1_000_000


def bucket_count(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET, least: int = 8, most: int = 50_000) -> int:
    """Buckets for data derived from ``rows`` landed rows: one file a year each, of as many rows however large the data."""
    return int(min(most, max(least, -(-rows // rows_per_bucket))))


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, columns: list[str], partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a bucketed table at ``path`` and return a scan of it that knows its buckets.

    Bucketing is catalog metadata, so the files belong to a table of a fresh
    name in :data:`SCRATCH_SCHEMA`; the current schema stays as it is.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quote_identifier(SCRATCH_SCHEMA)}")
    table = qualified(SCRATCH_SCHEMA, f"{name}_{uuid.uuid4().hex}")
    write_table(df, table, partition_by, path, (buckets, columns))
    return spark.table(table)


def set_table_comment(spark: SparkSession, table: str, text: str) -> None:
    spark.sql(f"COMMENT ON TABLE {table} IS {sql_string(text)}")


def set_column_comments(spark: SparkSession, table: str, comments: dict[str, str]) -> None:
    for col, text in comments.items():
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN {quote_identifier(col)} COMMENT {sql_string(text)}")


def column_comments(spark: SparkSession, table: str) -> dict[str, str]:
    """Read column comments back from the catalog."""
    return {
        f.name: f.metadata.get("comment")
        for f in spark.table(table).schema.fields
        if f.metadata.get("comment") is not None
    }


def comments(spark: SparkSession, schema: str) -> DataFrame:
    """Table, view and column comments of a schema as rows ``(object, column_name, comment)``.

    Read back from the catalog, whose size is the number of declared columns;
    an object's own comment has no column name.  Objects and columns without a
    comment have a row with a NULL comment.
    """
    rows = []
    for t in spark.catalog.listTables(schema):
        if t.isTemporary:
            continue
        rows.append((t.name, None, t.description or None))
        rows += [(t.name, c.name, c.description or None) for c in spark.catalog.listColumns(f"{quote_identifier(schema)}.{quote_identifier(t.name)}")]
    from ..sources.universe import literal_rows

    return literal_rows(spark, rows, ["object", "column_name", "comment"])


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """Bounded preview of a table (a limit is the feature here)."""
    return df.limit(n)


def save_with_comments(spark: SparkSession, df: DataFrame, table: str, fields, table_comment: str, **kw) -> None:
    write_table(df, table, **kw)
    set_table_comment(spark, table, table_comment)
    set_column_comments(spark, table, {n: c for n, _, c in fields if c and n in df.columns})


# Descriptions of the four views (written for this library).
VIEW_COMMENTS = {
    "vw_company_fundamentals": "Company profile joined to each fiscal year of statements; companies without filings keep one row.",
    "vw_stock_performance": "Daily bars of profiled tickers with company context and calendar parts.",
    "vw_stock_vs_benchmark": "Daily bars beside the market index with the excess daily return.",
    "vw_economic_overview": "Macro indicators per country and year with the projection flag.",
}


def view_sql(schema: str) -> dict[str, str]:
    """``CREATE OR REPLACE VIEW ... COMMENT ... AS SELECT`` text for the four views."""
    q = lambda t: qualified(schema, t)
    comp = ", ".join(f"c.{c}" for c in FUNDAMENTALS_COMPANY_COLS)
    fin = ", ".join(f"f.{c}" for c in FUNDAMENTALS_FACT_COLS)
    # trade_year is the stored partition column of the price fact (see storage_layout).
    parts = (
        "p.trade_year AS trade_year, CAST(MONTH({d}) AS INT) AS trade_month, "
        "CAST(QUARTER({d}) AS INT) AS trade_quarter"
    ).format(d="p.trade_date")
    bodies = {
        "vw_company_fundamentals": f"SELECT {comp}, {fin} FROM {q('dim_companies')} c "
        f"LEFT JOIN {q('fact_financials')} f ON c.ticker = f.ticker",
        "vw_stock_performance": "SELECT c.ticker, c.company_name, c.sector, c.industry, c.market_cap, "
        "p.trade_date, p.open_price, p.high_price, p.low_price, p.close_price, p.volume, "
        f"p.daily_return_pct, {parts} FROM {q('dim_companies')} c "
        f"JOIN {q('fact_stock_prices')} p ON c.ticker = p.ticker",
        "vw_stock_vs_benchmark": "SELECT c.ticker, c.company_name, c.sector, c.industry, c.beta, "
        "p.trade_date, p.close_price, p.daily_return_pct AS stock_daily_return_pct, "
        "b.close_price AS sp500_close, b.daily_return_pct AS sp500_daily_return_pct, "
        f"p.daily_return_pct - b.daily_return_pct AS excess_return_pct, {parts} "
        f"FROM {q('dim_companies')} c JOIN {q('fact_stock_prices')} p ON c.ticker = p.ticker "
        f"JOIN {q('fact_sp500_benchmark')} b ON p.trade_date = b.trade_date",
        "vw_economic_overview": "SELECT country_code, country, indicator_code, indicator_name, year, value, "
        f"is_projection FROM {q('fact_economic_indicators')}",
    }
    return {
        name: f"CREATE OR REPLACE VIEW {q(name)} COMMENT {sql_string(VIEW_COMMENTS[name])} AS {body}"
        for name, body in bodies.items()
    }


def storage_layout(name: str, df: DataFrame, clustered: int | None = None) -> tuple[DataFrame, list[str] | None, tuple | None]:
    """Physical layout of a table on write: ``(frame to write, partition columns, buckets)``.

    The daily price fact is the one table that grows with time at a fixed
    universe; its queries filter by calendar year, look up a ticker, or
    aggregate and join by ticker.  It is partitioned by ``trade_year`` (year
    filters prune folders), bucketed by ticker inside (joins and aggregations
    by ticker read it where it is, without an exchange) and sorted by ticker
    and date (ticker lookups skip row groups by their statistics).

    ``clustered`` is the number of buckets its rows already come in, by
    ticker; otherwise one exchange on the ticker is put in front of the
    writer, so that each bucket of a year is one file.
    """
    if name == "fact_stock_prices":
        out = df.withColumn("trade_year", F.year("trade_date").cast("int"))
        buckets = clustered or bucket_count(0)
        if not clustered:
            out = out.repartition(buckets, "ticker")
        return out, ["trade_year"], (buckets, ["ticker", "trade_date"])
    return df, None, None


def publish(
    spark: SparkSession,
    star: Star,
    schema: str,
    location: str | None = None,
    parallel: int = 4,
    report: dict | None = None,
) -> None:
    """Write the six tables with comments, then create the four views.

    The table loads are independent jobs and run concurrently (up to
    ``parallel``), then the views are created -- the reference job's order
    (loads side by side, views after both).  With ``location`` the tables
    are external, one folder per table under it (shared storage); otherwise
    they are managed by the catalog.  ``report`` receives the row count of
    each table, observed during its write.
    """
    from concurrent.futures import ThreadPoolExecutor

    from .star import TABLE_NAMES

    use_schema(spark, schema)

    def load(name):
        fields, comment = schemas.TABLES[name]
        where = f"{location.rstrip('/')}/{name}" if location else None
        data, parts, buckets = storage_layout(name, star.table(name), star.clustered)
        obs = None
        if report is not None:
            data, obs = observed(data, name)
        save_with_comments(
            spark, data, qualified(schema, name), fields, comment, location=where, partition_by=parts, buckets=buckets
        )
        if obs is not None:
            report[name] = obs.get["rows"]

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        list(pool.map(load, TABLE_NAMES))
    for stmt in view_sql(schema).values():
        spark.sql(stmt)


def star_from_catalog(spark: SparkSession, schema: str) -> Star:
    """A :class:`Star` over published tables (plain table scans)."""
    t = lambda n: spark.table(qualified(schema, n))
    return Star(
        dim_companies=t("dim_companies"),
        dim_sectors=t("dim_sectors"),
        fact_stock_prices=t("fact_stock_prices"),
        fact_sp500_benchmark=t("fact_sp500_benchmark"),
        fact_financials=t("fact_financials"),
        fact_economic_indicators=t("fact_economic_indicators"),
    )


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate result as parquet and return a scan of it.

    Used for results read by several consumers (computed once) and to cut
    long lineages: after a lost executor, tasks re-read these files instead
    of recomputing everything upstream.  ``path`` must be on shared storage.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def observed(df: DataFrame, name: str):
    """Attach a row-count observation; the count arrives with the write job.

    Replaces the reference's re-scan of each loaded table just to print its
    size: the metric is computed by the same tasks that write the rows.
    """
    obs = Observation(f"load_{name}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_with_layout(name: str, df: DataFrame, path: str, report: dict | None = None, clustered: int | None = None) -> DataFrame:
    """Write one star table with its storage layout and return a scan of it.

    When ``report`` is given, the number of rows written is stored in it
    under ``name`` (observed during the write, no second scan).
    """
    data, parts, buckets = storage_layout(name, df, clustered)
    obs = None
    if report is not None:
        data, obs = observed(data, name)
    if buckets:
        out = write_bucketed(data, name, path, *buckets, partition_by=parts)
    else:
        data.write.mode("overwrite").parquet(path)
        out = df.sparkSession.read.parquet(path)
    if obs is not None:
        report[name] = obs.get["rows"]
    return out


_PUBLISHED: dict = {}
_PUBLISH_LOCK = threading.Lock()


def published_star(spark: SparkSession, key, build, root: str) -> Star:
    """A :class:`Star` whose tables are written under ``root`` on first use.

    ``build()`` returns the lazy star; each table is derived and written
    once (per ``key``), then every query -- and every scalar subquery inside
    it -- scans the written files instead of re-deriving the table.  This is
    the load-then-query flow of the reference (load jobs publish tables,
    queries read them), with the files on shared storage.
    """
    from .star import TABLE_NAMES

    with _PUBLISH_LOCK:
        if key in _PUBLISHED:
            return _PUBLISHED[key]
        lazy = build()
        locks = {n: threading.Lock() for n in TABLE_NAMES}
        done: dict = {}

        def table(name):
            with locks[name]:
                if name not in done:
                    done[name] = write_with_layout(name, lazy.table(name), f"{root.rstrip('/')}/{name}", clustered=lazy.clustered)
                return done[name]

        star = Star(raw=lazy.raw, **{n: (lambda n=n: table(n)) for n in TABLE_NAMES})
        _PUBLISHED[key] = star
        return star


def materialize(star: Star, root: str, parallel: int = 4, report: dict | None = None) -> Star:
    """Write the six tables as parquet under ``root`` and return scans of them.

    ``root`` must be shared storage on a cluster (callers pass a folder under
    the session's ``spark.checkpoint.dir``).  Reading the written files back
    also cuts the lineage, so an executor lost later re-reads files instead
    of recomputing the whole derivation.

    The six tables are independent jobs (the two price facts share staged
    bars, which are staged once under a lock), so up to ``parallel`` of them
    run concurrently and the scheduler interleaves their tasks, as the
    reference's job runs its two loaders side by side.
    """
    from concurrent.futures import ThreadPoolExecutor

    from .star import TABLE_NAMES

    spark = star.raw["raw_profiles"].sparkSession if star.raw else star.dim_companies.sparkSession

    def write(name):
        return name, write_with_layout(name, star.table(name), f"{root.rstrip('/')}/{name}", report, star.clustered)

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        written = dict(pool.map(write, TABLE_NAMES))
    return Star(**written)
