"""Every SQL-checkable registered query equals its DuckDB oracle at sf0.001."""

import pytest

from oracle import compare, duckdb_connection
from pitwall import catalog

SQL_KEYS = sorted(catalog.ORACLE)


@pytest.fixture(scope="module")
def con(sf_small):
    return duckdb_connection(sf_small)


def test_every_query_is_registered():
    assert set(catalog.ORACLE) <= set(catalog.QUERIES)
    assert len(catalog.QUERIES) >= 45


@pytest.mark.parametrize("name", SQL_KEYS)
def test_query_matches_oracle(spark, sf_small, con, name):
    df = catalog.QUERIES[name](spark, sf_small)
    assert compare(df, con, catalog.ORACLE[name]) == []
