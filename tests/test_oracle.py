"""Every registered query against its SQL, on the smallest test tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from spendlake.plans.catalog import QUERIES
from spendlake.plans.oracle import ORACLE
from tests.check import connect, differences

# Minutes of training; ``python tests/check.py`` compares them.
SLOW = {"forecast_report", "forecast_runs", "grid_search"}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(ORACLE) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) - SLOW))
def test_query_matches_sql(spark, connection, sf_dir, name):
    assert differences(queries()[name](spark, sf_dir), connection, oracle_sql()[name]) == []


def test_entry(spark):
    result = entry(spark)
    assert result.columns[0] == "client_id"
    assert result.count() > 0
