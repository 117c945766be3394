"""Every registered query against independent SQL on the same tables."""

import pytest
from conftest import SMALL

import __spark_entry__ as entry_points
from tillstar import catalog
from tillstar.verification import oracle
from tillstar.verification.compare import differences, oracle_connection

QUERIES = catalog.queries()
ORACLE = oracle.statements()


@pytest.fixture(scope="module")
def connection():
    with oracle_connection(SMALL) as opened:
        yield opened


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert len(QUERIES) == 73


@pytest.mark.parametrize("name", QUERIES)
def test_matches_oracle(spark, connection, name):
    assert differences(QUERIES[name](spark, SMALL), connection, ORACLE[name]) == []


def test_comparison_notices_a_difference(spark, connection):
    query = QUERIES["eda_tx_by_year"](spark, SMALL)
    assert differences(query.limit(3), connection, ORACLE["eda_tx_by_year"])
    assert differences(query.withColumn("Row_Count", query.Row_Count + 1), connection, ORACLE["eda_tx_by_year"])
    assert differences(query.withColumnRenamed("Year", "y"), connection, ORACLE["eda_tx_by_year"])


def test_entry_points_offer_all_queries():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    first = entry_points.entry(spark)
    assert first.schema == entry_points.entry(spark).schema
    assert first.count() > 0
