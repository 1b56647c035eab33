"""Every registered query against its SQL, at the smallest scale."""

import pytest
from compare import connect, differences

import __spark_entry__ as contract
from reliq_queries.oracle import oracle_sql
from reliq_queries.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, oracle_sql()[name]) == []


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() == 1948
    assert result.columns[0] == "metric_date"


# Sizes measured on the driver tables.
EXPECTED = {
    "staging_customers": 139,
    "staging_accounts": 1394,
    "staging_transactions": 3906,
    "quarantine_transactions": 1401 + 942 + 105,
    "institutions_valid": 138,
    "institutions_rejected": 12,
}


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_measured_sizes(spark, name):
    assert contract.queries()[name](spark, SF).count() == EXPECTED[name]
