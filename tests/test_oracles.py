"""Every query against the independent SQL."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry_point
from footfall.fixtures import catalog, oracles


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracles.oracle_sql())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    df = catalog.queries()[name](spark, sf_dir)
    assert difference(df, duck, oracles.oracle_sql()[name]) is None


def test_entry_gives_rows(spark):
    assert entry_point.entry(spark).limit(1).count() == 1
