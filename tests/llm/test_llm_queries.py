"""The queries that SQL can express, against DuckDB on the smallest tables."""

import pytest
from oracle import compare, connect

from tidemark.llm.queries import ORACLES, RUNS


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf, name):
    assert compare(RUNS[name](spark, sf), connect(sf), ORACLES[name]) is None
