"""The queries of the subpackage against independent SQL on the same tables."""

import pytest

from tillstar.llm import queries, sql
from tillstar.verification.compare import differences, oracle_connection

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    with oracle_connection(SMALL) as opened:
        yield opened


@pytest.mark.parametrize("name", sql.statements())
def test_matches_oracle(spark, connection, name):
    assert differences(queries.queries()[name](spark, SMALL), connection, sql.statements()[name]) == []
