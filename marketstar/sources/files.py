"""File sources for landed records.

The reference pulls profiles, bars and statements over HTTP one ticker at a
time on the driver.  Here the same records arrive as files and are scanned
by Spark in parallel, all tickers at once, with a declared schema (no
inference pass, no driver-side loop).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas
from ..functions.exprs import nan_to_null_all


def read_delimited_panel(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Header-first delimited file, every column a string (inference off).

    Column names come from the header, so the set of year columns is
    whatever the file holds; callers intersect it with the years they want.
    All files of a folder must share one header: see :func:`read_panels`.
    """
    return (
        spark.read.option("header", "true")
        .option("sep", sep)
        .option("inferSchema", "false")
        .csv(path)
    )


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body)[0]


#: Cells of a panel row that are read at most; a row with more fails the query.
PANEL_CELLS = 128


def read_panels(spark: SparkSession, path: str, columns: Sequence[str], sep: str = "\t") -> DataFrame:
    """Delimited files of *different* headers, united by column name; every column a string.

    Each file's first line names its cells, so files may hold other years, or
    the same in another order.  A column that a file lacks is NULL in its rows.
    One row per file (its header) meets the file's rows; nothing is listed or
    read on the driver.  A later line equal to its file's header is one more
    header and goes, as do blank lines.
    """
    def cells(line: str) -> Column:
        row = F.from_csv(line, ", ".join(f"c{i} string" for i in range(PANEL_CELLS + 1)), {"sep": sep})
        return let(row, lambda r: F.array(*[r[f"c{i}"] for i in range(PANEL_CELLS + 1)]))

    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    lines = lines.where(F.length(F.trim("value")) > 0)
    placed = lines.withColumn("line", F.monotonically_increasing_id())  # rises within a block of a file
    headers = placed.groupBy("file").agg(F.min_by("value", F.struct("block", "line")).alias("header"))
    named = headers.select("file", "header", cells("header").alias("names"))
    rows = lines.join(named, "file").where(F.col("value") != F.col("header")).withColumn("cells", cells("value"))
    at = lambda name: F.array_position("names", F.lit(name))
    too_wide = F.raise_error(F.lit(f"panel row with more than {PANEL_CELLS} cells"))
    checked = F.when(F.col("cells")[PANEL_CELLS].isNull(), F.col("cells")).otherwise(too_wide.cast("array<string>"))
    rows = rows.select("names", checked.alias("cells"))
    return rows.select(*[F.when(at(c) > 0, F.try_element_at("cells", at(c).cast("int"))).alias(c) for c in columns])


def write_delimited_panel(df: DataFrame, path: str, sep: str = "\t") -> str:
    """Land a wide panel as a headed delimited file set (overwrite)."""
    df.write.mode("overwrite").option("header", "true").option("sep", sep).csv(path)
    return path


def _read(spark: SparkSession, path: str, fmt: str, schema) -> DataFrame:
    """Scan with a declared schema; NaN in numeric fields becomes NULL on ingest."""
    reader = spark.read.schema(schema)
    if fmt == "json":
        df = reader.json(path)
    elif fmt == "parquet":
        df = reader.parquet(path)
    elif fmt == "csv":
        df = reader.option("header", "true").csv(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return nan_to_null_all(df)


_CORRUPT = "_corrupt_record"
MALFORMED, NO_KEY = "malformed record", "no key"


def _cast(name: str, kind: str) -> Column:
    """A field's text as its declared type; a whole number may be written as a decimal one (12.0)."""
    text = F.nullif(F.trim(F.col(name)), F.lit(""))
    if kind == "bigint":
        return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))
    return text.try_cast(kind)


def checked_records(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], fmt: str = "json") -> DataFrame:
    """Landed text records with declared types and a ``record_error``, in one scan.

    Every field is read as text and cast in the plan, so a value that is
    present but no number (or date) is seen and named instead of becoming a
    silent NULL; a line that is no record at all keeps its error alone.  Blank
    text counts as missing.  NaN becomes NULL.
    """
    texts = StructType([StructField(f.name, StringType()) for f in schema.fields] + [StructField(_CORRUPT, StringType())])
    reader = spark.read.schema(texts).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT)
    if fmt == "json":
        raw = reader.json(path)
    elif fmt == "csv":
        raw = reader.option("header", "true").csv(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    typed, uncast = {}, []
    for f in schema.fields:
        kind = f.dataType.simpleString()
        typed[f.name] = F.col(f.name) if kind == "string" else _cast(f.name, kind)
        if kind != "string":
            text = F.nullif(F.trim(F.col(f.name)), F.lit(""))
            uncast.append(F.when(text.isNotNull() & typed[f.name].isNull(), F.concat(F.lit(f"{f.name} is no {kind}: "), text)))
    keyless = F.lit(False)
    for k in keys:
        keyless = keyless | F.coalesce(F.trim(F.col(k)), F.lit("")).eqNullSafe("")
    bad_fields = F.nullif(F.concat_ws("; ", *uncast), F.lit(""))
    error = F.when(F.col(_CORRUPT).isNotNull(), F.lit(MALFORMED)).when(keyless, F.lit(NO_KEY)).otherwise(bad_fields)
    out = raw.select(*[typed[f.name].alias(f.name) for f in schema.fields], error.alias("record_error"))
    return nan_to_null_all(out)


def has_key(checked: DataFrame) -> Column:
    """Records that name their key (they may still hold fields that are no numbers)."""
    return ~F.coalesce(checked["record_error"], F.lit("")).isin(MALFORMED, NO_KEY)


def read_checked_profiles(spark: SparkSession, path: str, fmt: str = "json") -> tuple[DataFrame, DataFrame]:
    """(profiles, checked): profiles are the records with a ticker, where a field that is no number makes the record a
    failed fetch (default row, quarantined) as a failed conversion does in the source's loader; ``checked`` holds all
    records for :func:`marketstar.plans.star.profile_quarantine`."""
    checked = checked_records(spark, path, schemas.RAW_PROFILES, ["ticker"], fmt)
    good = checked.where(has_key(checked)).withColumn("fetch_error", F.coalesce("fetch_error", "record_error"))
    return good.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in schemas.RAW_PROFILES]), checked


def read_profiles(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Landed company profile records (one per ticker, optional ``fetch_error``); never one without a ticker."""
    if fmt == "parquet":
        return _read(spark, path, fmt, schemas.RAW_PROFILES).where(F.col("ticker").isNotNull())
    return read_checked_profiles(spark, path, fmt)[0]


def read_prices(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed daily bars for all tickers."""
    return _read(spark, path, fmt, schemas.RAW_PRICES)


def read_index(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed daily bars of the market index."""
    return _read(spark, path, fmt, schemas.RAW_INDEX)


def read_statements(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed statement line items in long form."""
    return _read(spark, path, fmt, schemas.RAW_STATEMENTS)
