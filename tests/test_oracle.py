"""Every query with a SQL twin must give the same rows, and every query must run."""

import pytest
from compare import differences
from helpers import result

import __spark_entry__ as entry_point
from txguard.oracle import ORACLE as SQL
from txguard.plans.queries import QUERIES



def test_all_have_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal_to_sql(spark, duck, sf, name):
    assert differences(result(QUERIES, name, spark, sf), duck, SQL[name]) == ""


def test_all_are_registered():
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(SQL) <= set(entry_point.oracle_sql())


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() == 178 and "final_fraud_status" in df.columns


@pytest.mark.parametrize("name", ["temporal_features", "velocity_features", "fraud_rate_windows"])
def test_results_do_not_follow_the_session_time_zone(spark, duck, sf, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert differences(QUERIES[name](spark, sf), duck, SQL[name]) == ""
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
