"""Results do not depend on the session's time zone or ANSI mode."""

import pytest

import __spark_entry__ as E
from compare import compare, duck
from marketstar.plans.queries import DEFAULT, QUERIES
from marketstar.plans.star import star_from_driver

NAMES = [
    "q_l03_price_coverage", "q_l06_indicator_coverage", "q_l09_stock_last_days", "q_l11_inflation_latest_actual",
    "q_l17_sector_outperformance", "q_l22_ytd_best", "q_l23_most_volatile", "q_l25_inflation_max_year",
    "v_indicator_totals", "q_ask_best_sector_returns",
]


@pytest.fixture(scope="module")
def other(spark):
    s = spark.newSession()
    s.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    s.conf.set("spark.sql.ansi.enabled", "false")
    return s


@pytest.fixture(scope="module")
def star(other, sf_small):
    return star_from_driver(other, sf_small)


def test_plans_kept_for_reuse_belong_to_one_session(spark, other, sf_small):
    """Neither scans nor staged or published tables of one session are handed to another."""
    from marketstar.plans.registry import _star
    from marketstar.session import session_key
    from marketstar.sources.tables import TableSource

    assert session_key(spark) == session_key(spark) != session_key(other)
    assert TableSource(other, sf_small)("orders").sparkSession is other
    assert TableSource(spark, sf_small)("orders").sparkSession is spark
    mine, theirs = _star(spark, sf_small), _star(other, sf_small)
    assert mine is _star(spark, sf_small) and mine is not theirs
    assert theirs.fact_stock_prices.sparkSession.conf.get("spark.sql.session.timeZone") == "America/Los_Angeles"
    assert mine.fact_stock_prices.sparkSession.conf.get("spark.sql.session.timeZone") == "UTC"


@pytest.mark.parametrize("name", NAMES)
def test_same_answer_in_other_time_zone_without_ansi(star, sf_small, name):
    r = compare(QUERIES[name](star, DEFAULT), duck(sf_small), E.oracle_sql()[name])
    assert r["ok"], r
