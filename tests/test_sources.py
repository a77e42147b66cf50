"""File sources and literal inputs."""

import json

import pytest

from marketstar import schemas
from marketstar.plans import star as K
from marketstar.session import scratch_path
from marketstar.sources import files, landed, universe
from marketstar.sources.tables import TableSource


def test_tsv_roundtrip_matches_in_memory_panel(spark, sf_small):
    wide = landed.raw_indicator_panel(TableSource(spark, sf_small))
    path = files.write_delimited_panel(wide, scratch_path(spark, "tsv"))
    back = files.read_delimited_panel(spark, path)
    assert set(back.columns) == set(wide.columns)
    assert all(t == "string" for _, t in back.dtypes)
    spec = K.driver_indicator_spec()
    a = sorted(map(tuple, K.indicators(wide, spec).collect()))
    b = sorted(map(tuple, K.indicators(back, spec).collect()))
    assert a == b


def test_json_profiles_reader(spark):
    path = scratch_path(spark, "profiles_json")
    import os

    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part-0.json", "w") as fh:
        fh.write(json.dumps({"ticker": "AAA", "company_name": "A Co", "curated_sector": "Energy", "market_cap": 2.5e11}) + "\n")
        fh.write(json.dumps({"ticker": "BBB", "company_name": "B Co", "curated_sector": "Energy", "fetch_error": "boom"}) + "\n")
    raw = files.read_profiles(spark, path)
    assert raw.schema == schemas.RAW_PROFILES
    rows = {r.ticker: r for r in K.companies(raw).collect()}
    assert rows["AAA"].market_cap == 2.5e11 and rows["BBB"].industry == "Unknown"


def test_flatten_universe(spark):
    nested = {"Energy": {"XOM": "Exxon", "CVX": "Chevron"}, "Utilities": {"SO": "Southern"}}
    got = sorted(map(tuple, universe.flatten_universe(spark, nested).collect()))
    assert got == [("CVX", "Chevron", "Energy"), ("SO", "Southern", "Utilities"), ("XOM", "Exxon", "Energy")]


def test_sectors_literal(spark):
    df = universe.sectors(spark)
    assert df.count() == 11
    assert not df.schema["sector_name"].nullable


def test_index_rollup_equals_direct_aggregation(spark, sf_small):
    src = TableSource(spark, sf_small)
    rolled = landed.index_from_bars(landed.daily_bars(src))
    from pyspark.sql import functions as F

    li = src.lineitem
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    key = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    direct = li.groupBy(F.to_date("l_shipdate").alias("trade_date")).agg(
        F.min_by(unit, key).alias("open_price"), F.max(unit).alias("high_price"), F.min(unit).alias("low_price"),
        F.max_by(unit, key).alias("close_price"), F.sum("l_quantity").cast("bigint").alias("volume"))
    assert rolled.exceptAll(direct).count() == 0 and direct.exceptAll(rolled).count() == 0


def test_landed_file_readers_roundtrip(spark, sf_small):
    """Bars, index and statements landed as parquet, scanned with declared schemas."""
    src = TableSource(spark, sf_small)
    root = scratch_path(spark, "landed")
    frames = {
        "prices": (landed.raw_prices(src), files.read_prices),
        "index": (landed.raw_index(src), files.read_index),
        "statements": (landed.raw_statements(src), files.read_statements),
    }
    for name, (df, reader) in frames.items():
        df.write.parquet(f"{root}/{name}")
        back = reader(spark, f"{root}/{name}")
        assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0, name
    fin_a = K.financials(files.read_statements(spark, f"{root}/statements"))
    assert fin_a.count() == 70


def test_params_default_to_today(spark):
    import datetime as dt

    from marketstar.plans.queries import DEFAULT, Params

    today, year, pinned = spark.range(1).select(Params().day, Params().year, DEFAULT.year).first()
    assert abs((today - dt.datetime.now(dt.timezone.utc).date()).days) <= 1 and year == today.year and pinned == 2000
    assert DEFAULT.as_of_date == dt.date(2000, 12, 31)
    with pytest.raises(ValueError):
        Params().as_of_date


def test_nan_becomes_null_on_ingest(spark):
    path = scratch_path(spark, "nan_bars")
    rows = [("A", __import__("datetime").date(2000, 1, 3), float("nan"), 2.0, 1.0, 1.5, 10)]
    spark.createDataFrame(rows, schemas.RAW_PRICES).write.parquet(path)
    (r,) = files.read_prices(spark, path).collect()
    assert r.open_price is None and r.close_price == 1.5


def test_star_from_landed_files_equals_driver_star(spark, sf_small):
    """The user path: every landed input read from files, then the same transforms."""
    lazy = K.star_from_driver(spark, sf_small, stage_bars=False)
    raw = lazy.raw
    root = scratch_path(spark, "landed_all")
    raw["raw_profiles"].write.json(f"{root}/profiles")
    raw["raw_prices"].write.parquet(f"{root}/prices")
    raw["raw_index"].write.parquet(f"{root}/index")
    raw["raw_statements"].write.parquet(f"{root}/statements")
    files.write_delimited_panel(raw["raw_panel"], f"{root}/panel")
    landed_raw = {
        "raw_profiles": files.read_profiles(spark, f"{root}/profiles"),
        "raw_prices": files.read_prices(spark, f"{root}/prices"),
        "raw_index": files.read_index(spark, f"{root}/index"),
        "raw_statements": files.read_statements(spark, f"{root}/statements"),
        "raw_panel": files.read_delimited_panel(spark, f"{root}/panel"),
    }
    from_files = K.build_star(spark, landed_raw)
    for name in K.TABLE_NAMES:
        a, b = lazy.table(name), from_files.table(name)
        assert a.columns == b.columns, name
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_params_latest_anchor(spark, sf_small):
    import datetime as dt

    from marketstar.plans.queries import Params

    p = Params.latest(K.star_from_driver(spark, sf_small), ticker="S2")
    assert tuple(spark.range(1).select(p.day, p.year).first()) == (dt.date(2001, 11, 4), 2001) and p.ticker == "S2"


def _lines(spark, name, lines):
    path = scratch_path(spark, name)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_malformed_and_uncast_records(spark):
    path = _lines(
        spark,
        "bad_profiles",
        [
            '{"ticker": "AAA", "company_name": "A", "curated_sector": "Energy", "market_cap": 2.5e11, "employees": 12.0, "beta": NaN}',
            '{"ticker": "BBB", "company_name": "B", "curated_sector": "Energy", "market_cap": "abc", "employees": "many"}',
            '{"ticker": "CCC", "company_name": ',
            '{"company_name": "no ticker", "curated_sector": "Energy"}',
            '{"ticker": " ", "curated_sector": "Energy"}',
            "not json at all",
            '{"ticker": "DDD", "curated_sector": "Energy", "fetch_error": "timeout", "market_cap": ""}',
        ],
    )
    profiles, checked = files.read_checked_profiles(spark, path)
    assert checked.count() == 7
    assert profiles.schema.names == schemas.RAW_PROFILES.names
    got = {r.ticker: r for r in K.companies(profiles).collect()}
    assert set(got) == {"AAA", "BBB", "DDD"}  # no company without a ticker
    assert got["AAA"].market_cap == 2.5e11 and got["AAA"].employees == 12 and got["AAA"].beta == 0.0
    assert got["BBB"].sector == "Energy" and got["BBB"].market_cap == 0.0 and got["BBB"].industry == "Unknown"
    none = spark.createDataFrame([], schemas.RAW_PRICES)
    some = spark.createDataFrame([("AAA", "income", None, "Net Income", 1.0), ("BBB", "income", None, "EBIT", 1.0)], schemas.RAW_STATEMENTS)
    bars = spark.createDataFrame([("AAA", None, 1.0, 1.0, 1.0, 1.0, 1), ("DDD", None, 1.0, 1.0, 1.0, 1.0, 1)], schemas.RAW_PRICES)
    rows = sorted((str(t), s, e) for t, s, e in K.profile_quarantine(profiles, bars, some, checked).collect())
    assert rows == [
        ("BBB", "prices", "no price rows"),
        ("BBB", "profile", "market_cap is no double: abc; employees is no bigint: many"),
        ("DDD", "profile", "timeout"),
        ("DDD", "statements", "no income statement"),
        ("None", "landing", "malformed record"),
        ("None", "landing", "malformed record"),
        ("None", "landing", "no key"),
        ("None", "landing", "no key"),
    ]
    assert K.profile_quarantine(profiles, none, some).where("stage = 'prices'").count() == 3


def test_empty_landing_has_no_records(spark):
    profiles, checked = files.read_checked_profiles(spark, _lines(spark, "no_profiles", []))
    assert profiles.count() == checked.count() == 0


def test_panels_of_different_headers_unite_by_name(spark):
    path = scratch_path(spark, "panels")
    ids = "ISO\tCountry\tWEO Subject Code\tEstimates Start After"
    for name, lines in {
        "a": [ids + "\t2015\t2016", "AAA\tA land\tX\t2019\t1.5\t2,000.25", 'AAB\t"B\tland"\tX\t\tn/a\t7'],
        "b": ["2016\t2020\t" + ids, "9\t--\tCCC\tC land\tX\t2019", "", "8\t4\tCCD\tD land\tX\t2019", "2016\t2020\t" + ids],
        "c": [ids],
    }.items():
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{path}/{name}")
    columns = [*K.WIDE_ID_COLUMNS, "2015", "2016", "2018", "2020"]
    got = files.read_panels(spark, f"{path}/*", columns)
    assert got.columns == columns
    assert sorted(map(tuple, got.collect())) == [
        ("AAA", "A land", "X", "2019", "1.5", "2,000.25", None, None),
        ("AAB", "B\tland", "X", None, "n/a", "7", None, None),
        ("CCC", "C land", "X", "2019", None, "9", None, "--"),
        ("CCD", "D land", "X", "2019", None, "8", None, "4"),
    ]
    spec = K.IndicatorSpec(codes={"X": "x"}, countries=("A land", "C land"))
    long = K.indicators(got, spec).orderBy("country_code", "year").collect()
    assert [(r.country_code, r.year, r.value, r.is_projection) for r in long] == [("AAA", 2015, 1.5, "N"), ("AAA", 2016, 2000.25, "N"), ("CCC", 2016, 9.0, "N")]
