"""A supplier holding a third of all line items: results stay whole and exact."""

import pytest
from pyspark.sql import functions as F

from compare import compare, duck
from marketstar.plans import star as K
from marketstar.session import scratch_path
from marketstar.sources import landed
from marketstar.sources.tables import TableSource


@pytest.fixture(scope="module")
def skewed_dir(spark, sf_small):
    src = TableSource(spark, sf_small)
    root = scratch_path(spark, "skewed")
    li = src.lineitem
    hot = li.withColumn("l_suppkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("l_suppkey")))
    hot.write.parquet(f"{root}/lineitem.parquet")
    for t in ("supplier", "nation", "region"):
        src(t).write.parquet(f"{root}/{t}.parquet")
    return root


def test_hot_supplier_bars_match_direct_sql(spark, skewed_dir):
    src = TableSource(spark, skewed_dir)
    (share,) = src.lineitem.agg(F.avg((F.col("l_suppkey") == 0).cast("double"))).first()
    assert share > 0.33
    from marketstar.plans.oracle import CTES

    con = duck(skewed_dir.replace("file:", ""))
    prices = K.stock_prices(landed.raw_prices(src))
    sql = "with raw_prices as (" + CTES["raw_prices"][0] + ") " + CTES["fact_stock_prices"][0]
    r = compare(prices, con, sql)
    assert r["ok"], r
    fin = K.financials(landed.raw_statements(src))
    from marketstar.plans.oracle import with_ctes

    r = compare(fin, con, with_ctes("select * from fact_financials", ["fact_financials"]))
    assert r["ok"], r


def test_hot_customer_indicator_panel_matches_sql(spark, sf_small):
    src = TableSource(spark, sf_small)
    root = scratch_path(spark, "skewed_orders")
    o = src.orders
    hot = o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(1).cast("bigint")).otherwise(F.col("o_custkey")))
    hot.write.parquet(f"{root}/orders.parquet")
    for t in ("customer", "nation"):
        src(t).write.parquet(f"{root}/{t}.parquet")
    hsrc = TableSource(spark, root)
    (share,) = hsrc.orders.agg(F.avg((F.col("o_custkey") == 1).cast("double"))).first()
    assert share > 0.33
    from marketstar.plans.oracle import with_ctes

    ind = K.indicators(landed.raw_indicator_panel(hsrc), K.driver_indicator_spec())
    r = compare(ind, duck(root), with_ctes("select * from fact_economic_indicators", ["fact_economic_indicators"]))
    assert r["ok"], r
