"""The queries that SQL can express, against it."""

import pytest
from compare import connect, difference

from footfall.llm import oracles, queries


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_matches_sql(llm, sf_dir, name):
    df = queries.queries()[name](llm, sf_dir)
    assert difference(df, connect(sf_dir), oracles.oracle_sql()[name]) is None
