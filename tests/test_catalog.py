"""Sinks, comments, identifier quoting and published views."""

from marketstar.plans import catalog
from marketstar.plans.star import star_from_driver
from marketstar.session import scratch_path


def test_quoting():
    assert catalog.quote_identifier("a`b") == "`a``b`"
    assert catalog.qualified("s", "t") == "`s`.`t`"
    assert catalog.sql_string("it's a \\ test") == "'it\\'s a \\\\ test'"


def test_publish_with_comments_and_views(spark, sf_small):
    schema = "ms_test_publish"
    star = star_from_driver(spark, sf_small)
    where = scratch_path(spark, "publish")
    loaded = {}
    catalog.publish(spark, star, schema, location=where, report=loaded)
    assert loaded["fact_stock_prices"] == 5334 and loaded["dim_sectors"] == 11
    t = catalog.qualified(schema, "fact_stock_prices")
    comments = catalog.column_comments(spark, t)
    assert comments["close_price"].startswith("Last trade price")
    # Re-publishing overwrites the table and re-applies the comments.
    catalog.publish(spark, star, schema, location=where)
    assert catalog.column_comments(spark, t) == comments
    back = catalog.star_from_catalog(spark, schema)
    assert back.fact_stock_prices.count() == star.fact_stock_prices.count()
    n = spark.sql(f"SELECT COUNT(*) FROM {catalog.qualified(schema, 'vw_stock_vs_benchmark')}").first()[0]
    assert n == 5334
    desc = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {catalog.qualified(schema, 'vw_company_fundamentals')}").collect()}
    assert "Comment" in desc
    spark.sql("USE SCHEMA default")


def test_comment_with_quote(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS ms_test_quote")
    t = catalog.qualified("ms_test_quote", "q")
    catalog.write_table(spark.range(3).withColumnRenamed("id", "x"), t, location=scratch_path(spark, "q"))
    catalog.set_column_comments(spark, t, {"x": "the company's key"})
    catalog.set_table_comment(spark, t, "O'Brien's table")
    assert catalog.column_comments(spark, t) == {"x": "the company's key"}
    assert catalog.preview(spark.table(t), 2).count() == 2


def test_materialize_cuts_lineage(spark, sf_small):
    star = star_from_driver(spark, sf_small)
    root = scratch_path(spark, "mat")
    report = {}
    m = catalog.materialize(star, root, report=report)
    assert report == {"dim_companies": 10, "dim_sectors": 11, "fact_stock_prices": 5334,
                      "fact_sp500_benchmark": 2289, "fact_financials": 70, "fact_economic_indicators": 542}
    assert m.fact_financials.count() == 70
    files = m.fact_financials.inputFiles()
    assert files and all(f"{root}/fact_financials" in f for f in files)


def test_materialized_star_answers_like_lazy_plans(spark, sf_small):
    from marketstar.plans.queries import DEFAULT, QUERIES

    lazy = star_from_driver(spark, sf_small)
    stored = catalog.materialize(lazy, scratch_path(spark, "mat_eq"))
    assert "trade_year" in stored.fact_stock_prices.columns
    assert "trade_year" not in stored.tables()["fact_stock_prices"].columns
    for name in ["q_l09_stock_last_days", "q_l17_sector_outperformance", "q_l22_ytd_best",
                 "q_l23_most_volatile", "q_l27_stock_vs_index_prior_year", "v_rows_and_columns", "q_l12_row_inventory"]:
        a = sorted(map(tuple, QUERIES[name](lazy, DEFAULT).collect()))
        b = sorted(map(tuple, QUERIES[name](stored, DEFAULT).collect()))
        assert a == b, name


def test_sql_over_registered_views_matches_dataframe_query(spark, sf_small):
    from marketstar.plans import views as V
    from marketstar.plans.queries import DEFAULT, l17_sector_outperformance

    star = star_from_driver(spark, sf_small)
    V.register_temp_views(spark, star)
    sql = """
        SELECT sector,
               CAST(ROUND(CAST(AVG(stock_daily_return_pct) AS DECIMAL(38,12)), 4) AS DOUBLE) AS avg_sector_return,
               CAST(ROUND(CAST(AVG(sp500_daily_return_pct) AS DECIMAL(38,12)), 4) AS DOUBLE) AS avg_sp500_return,
               CAST(ROUND(CAST(AVG(excess_return_pct) AS DECIMAL(38,12)), 4) AS DOUBLE) AS avg_excess_return,
               COUNT(DISTINCT ticker) AS stocks
        FROM vw_stock_vs_benchmark
        WHERE trade_year = YEAR(CAST(:as_of AS DATE))
        GROUP BY sector
    """
    a = sorted(map(tuple, spark.sql(sql, args={"as_of": DEFAULT.as_of}).collect()))
    b = sorted(map(tuple, l17_sector_outperformance(star, DEFAULT).collect()))
    assert a == b
    n = spark.sql("SELECT COUNT(*) FROM dim_companies").first()[0]
    assert n == star.dim_companies.count()


def test_load_job(spark, sf_small):
    from marketstar.plans import job

    report = job.run(spark, sf_small, "ms_test_job", location=scratch_path(spark, "job"))
    assert report["fact_financials"] == 70 and report["fact_economic_indicators"] == 542
    n = spark.sql("SELECT COUNT(*) FROM `ms_test_job`.`vw_economic_overview`").first()[0]
    assert n == 542
    spark.sql("USE SCHEMA default")


def test_comments_as_rows_and_schema_kept(spark, sf_small):
    from marketstar.plans.registry import registry

    spark.sql("CREATE SCHEMA IF NOT EXISTS ms_test_current")
    spark.sql("USE SCHEMA ms_test_current")
    try:
        registry()["table_roundtrip"](spark, sf_small)
        rows = {(r.object, r.column_name): (r.comment, r.object_rows) for r in registry()["catalog_comments"](spark, sf_small).collect()}
        assert spark.catalog.currentDatabase() == "ms_test_current"
    finally:
        spark.sql("USE SCHEMA default")
    assert rows["vw_economic_overview", None] == (catalog.VIEW_COMMENTS["vw_economic_overview"], 542)
    assert rows["fact_stock_prices", "close_price"][0].startswith("Last trade price") and rows["fact_stock_prices", "trade_year"][0] is None
    catalog.write_table(spark.range(2), "`ms_test_current`.`plain`", location=scratch_path(spark, "plain"))
    assert ("plain", "id", None) in set(map(tuple, catalog.comments(spark, "ms_test_current").collect()))
