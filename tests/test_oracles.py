"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
from clickflow.plans.catalog import all_oracles, all_queries
from oracle import assert_same

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, name):
    assert assert_same(QUERIES[name](spark, FOLDER), ORACLES[name], FOLDER) > 0


def test_all_are_registered():
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert ORACLES.keys() <= entry_point.oracle_sql().keys()


def test_entry_gives_rows(spark):
    result = entry_point.entry(spark)
    assert result.columns == ["channelId", "yearMonthDayHour", "pv", "uv"]
    assert result.count() > 0
