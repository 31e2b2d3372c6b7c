"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry_module

from watchspan.plans.driver_oracles import ORACLES
from watchspan.plans.driver_queries import all_queries

QUERIES = all_queries()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_all_are_registered():
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    result = compare(QUERIES[name](spark, sf_dir), con, ORACLES[name])
    assert result["ok"], result


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["fact_token", "fact_token_scope", "geo_activity_daily", "client_scope_drift", "run_coverage"])
def test_large_lookups_equal_sql(spark, sf_dir, con, name):
    """The same with no table counted as small enough to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        query = QUERIES[name](spark, sf_dir)
        assert "_salt" in query._jdf.queryExecution().analyzed().toString()
        result = compare(query, con, ORACLES[name])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert result["ok"], result
