"""Physical-plan shape: the scale properties the design relies on."""

import contextlib
import io

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E
from marketstar.functions import semantic as S
from marketstar.plans.registry import registry
from marketstar.plans import catalog, queries as Q, star as K, views as V
from marketstar.plans.star import star_from_driver
from marketstar.session import scratch_path
from marketstar.sources import landed
from marketstar.sources.tables import TableSource


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_bars_shuffle_on_both_keys_after_partial_aggregation(spark, sf_small):
    text = plan(landed.daily_bars(TableSource(spark, sf_small)), "simple")
    exchanges = [l for l in text.splitlines() if "Exchange hashpartitioning" in l]
    assert len(exchanges) == 1 and "l_suppkey" in exchanges[0] and "trade_date" in exchanges[0]
    below = text.split("Exchange hashpartitioning", 1)[1]
    assert "partial_" in below  # map-side combine before the shuffle
    assert "PushedFilters: [IsNotNull(l_suppkey)]" in plan(landed.daily_bars(TableSource(spark, sf_small)))


def test_bars_are_hash_aggregated(spark, sf_small):
    src = TableSource(spark, sf_small)
    for df in (landed.daily_bars(src), landed.raw_index(src)):
        text = plan(df, "simple")
        assert "HashAggregate" in text and "SortAggregate" not in text and "Sort [" not in text


def test_line_key_keeps_the_order_of_its_fields(spark):
    rows = [(1, 2, 3, 900.68, 1.0), (1, 2, 3, 900.68, 2.0), (1, 2, 3, 900.69, 0.0), (1, 2, 10, 1.0, 1.0), (1, 11, 0, 0.01, 5.0), (9999999999999, 0, 0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_extendedprice double, l_quantity double")
    keyed = df.select("*", landed._line_key().alias("k")).orderBy("k").select("*", landed._line_price("k").alias("px")).collect()
    assert [tuple(r)[:5] for r in keyed] == rows
    assert [r["px"] for r in keyed] == [900.68, 450.34, None, 1.0, 0.002, None]
    for bad in [(10**13, 1, 1, 1.0, 1.0), (1, 1, 1, 1.005, 1.0), (1, 1, 1, 1.0, 1.5), (1, 1, 1, -1.0, 1.0)]:
        with pytest.raises(Exception, match="packed line key"):
            spark.createDataFrame([bad], df.schema).select(landed._line_key()).collect()
    assert spark.createDataFrame([(1, 1, 1, None, 1.0)], df.schema).select(landed._line_key()).first()[0] is None


def test_orders_preaggregated_before_customer_join(spark, sf_small):
    text = plan(landed.raw_indicator_panel(TableSource(spark, sf_small)), "simple")
    first_join = text.rfind("Join")
    scan = text.find("FileScan parquet [o_custkey")
    # below the customer join, above the scan of the orders
    assert first_join < text.find("partial_sum", first_join) < scan


def test_materialized_fact_prunes_and_pushes(spark, sf_small):
    stored = catalog.materialize(star_from_driver(spark, sf_small), scratch_path(spark, "plans"))
    text = plan(Q.l17_sector_outperformance(stored))
    assert "PartitionFilters: [isnotnull(trade_year" in text and "= 2000)" in text
    assert "GreaterThanOrEqual(trade_date,2000-01-01)" in text
    text9 = plan(Q.l09_stock_last_days(stored))
    assert "EqualTo(ticker,S1)" in text9
    assert "TakeOrderedAndProject" in plan(Q.l09_stock_last_days(stored), "simple")


@pytest.fixture(scope="module")
def stored(spark, sf_small):
    return catalog.materialize(star_from_driver(spark, sf_small), scratch_path(spark, "shapes"))


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _exchanges_below_fact(text):
    """Whether an Exchange stands between the price fact's scan and the node that first joins or aggregates it."""
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan parquet" in line and "fact_stock_prices" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
    above, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            level = depth(line)
            above.append(line)
            if "Join" in line:
                break
    return [line for line in above if "Exchange" in line]


def test_fact_is_joined_and_aggregated_where_it_is(spark, stored, no_broadcast):
    """Companies come to the bucketed fact; its rows stay (no Exchange on its side of the ticker join)."""
    for df in (V.stock_performance(stored), V.stock_vs_benchmark(stored)):
        assert not _exchanges_below_fact(plan(df, "simple"))
    text = plan(stored.fact_stock_prices.groupBy("ticker").agg(F.max("close_price")), "simple")
    assert "Exchange" not in text and "Bucketed: true" in plan(stored.fact_stock_prices.groupBy("ticker").agg(F.max("close_price")))
    text = plan(stored.fact_stock_prices.select("ticker", F.lag("close_price").over(Window.partitionBy("ticker").orderBy("trade_date"))), "simple")
    assert "Exchange" not in text


def test_returns_and_statements_of_staged_bars_need_no_exchange(spark, sf_small):
    raw = star_from_driver(spark, sf_small).raw
    text = plan(K.stock_prices(raw["raw_prices"]), "simple")
    assert "Window" in text and "Exchange" not in text
    assert "Exchange" not in plan(landed.statement_base(raw["bars"]), "simple")


def test_index_returns_read_the_bars_once(spark, sf_small):
    df = K.benchmark(star_from_driver(spark, sf_small).raw["raw_index"])
    rows = df.orderBy("trade_date").collect()
    df = K.benchmark(star_from_driver(spark, sf_small).raw["raw_index"])
    df.collect()
    text = plan(df, "simple").split("Initial Plan")[0]
    assert len(rows) == 2289 and text.count("FileScan") == 1 and "ReusedExchange" in text


@pytest.mark.parametrize("query", [Q.l22_ytd_best, Q.ytd_best_minmax_by, Q.l23_most_volatile])
def test_companies_meet_one_row_per_ticker(spark, stored, query):
    text = plan(query(stored), "simple")
    scan = next(line for line in text.splitlines() if "fact_stock_prices" in line and "FileScan" in line)
    assert "PartitionFilters: [isnotnull(trade_year" in scan
    lines = text.splitlines()
    reduced = min(i for i, line in enumerate(lines) if "Aggregate" in line or "Window" in line)
    # names are joined above the top-k, and the top-k stands above every aggregate and window
    names = next(i for i, line in enumerate(lines) if "FileScan" in line and "company_name" in line)
    topk = [i for i, line in enumerate(lines) if "TakeOrdered" in line]
    assert len(topk) == 2 and topk[0] < topk[1] < reduced and names != reduced
    window = [line for line in lines if "Window" in line or "Aggregate" in line]
    assert window and not any("company_name" in line or "sector" in line for line in window)


def test_inventory_reads_the_price_fact_once(spark, stored):
    for order in ("notebook", "view_script"):
        text = plan(Q.inventory(stored, order), "simple")
        assert sum("FileScan" in line and "fact_stock_prices" in line for line in text.splitlines()) == 1


def test_filter_counts_multiply_no_row(spark, stored):
    text = plan(S.filter_counts(V.company_fundamentals(stored), [m.name for m in S.FILTERS]), "simple")
    assert "Generate" not in text and text.count("HashAggregate") >= 4


def test_as_of_day_is_part_of_the_plan(spark, stored):
    """Today and the latest day reach the scan as partition filters."""
    today = plan(Q.l17_sector_outperformance(stored, Q.Params()))
    year = spark.range(1).select(F.year(F.current_date())).first()[0]
    assert f"(trade_year#" in today and f" = {year})" in today.split("PartitionFilters: [isnotnull(trade_year", 1)[1][:80]
    latest = plan(Q.l17_sector_outperformance(stored, Q.Params.latest(stored)))
    assert "Subquery" in latest.split("PartitionFilters: [isnotnull(trade_year", 1)[1][:200]
    got = Q.l17_sector_outperformance(stored, Q.Params.latest(stored)).orderBy("sector").collect()
    assert got == Q.l17_sector_outperformance(stored, Q.Params(as_of="2001-11-04")).orderBy("sector").collect() and got


@pytest.mark.parametrize("name", sorted(registry()))
def test_no_python_evaluation(spark, sf_small, name):
    text = plan(E.queries()[name](spark, sf_small), "simple")
    for marker in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert marker not in text
    # No cross joins: every join has an equi-key.
    for marker in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert marker not in text


def test_no_broadcast_hints_and_no_jobs_while_planning(spark, sf_small):
    """Joins are plain; building a view over a published star starts no Spark job."""
    import pathlib

    root = pathlib.Path(__file__).resolve().parents[1] / "marketstar"
    own = [p for p in root.rglob("*.py") if "llm" not in p.parts]
    assert not [p.name for p in own if "broadcast(" in p.read_text()]
    stored = catalog.materialize(star_from_driver(spark, sf_small), scratch_path(spark, "nojobs"))
    tracker, group = spark.sparkContext.statusTracker(), "planning-only"
    spark.sparkContext.setJobGroup(group, group)
    for build in (V.company_fundamentals, V.stock_performance, V.stock_vs_benchmark, V.economic_overview):
        build(stored)
    assert not tracker.getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_library_never_pulls_data_to_the_driver():
    """Static check: no collect/toPandas/take/RDD access anywhere in the package."""
    import pathlib
    import re

    root = pathlib.Path(__file__).resolve().parents[1] / "marketstar"
    # ``F.first`` (an aggregate) is fine; ``df.first()`` (an action) is not.
    pattern = re.compile(r"(?<!F)\.(collect|toPandas|toLocalIterator|take|head|first)\(|\.rdd\b")
    offenders = [
        f"{path.name}:{i}"
        for path in root.rglob("*.py")
        if "llm" not in path.parts
        for i, line in enumerate(path.read_text().splitlines(), 1)
        if pattern.search(line)
    ]
    assert offenders == []
