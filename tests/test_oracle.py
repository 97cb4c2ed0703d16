"""Every query with an SQL twin equals DuckDB on sf0.001 (schema, row count and values)."""

import pytest

from conftest import SF_SMALL
from oracle_compare import compare

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF_SMALL, sorted(entry.oracle_sql()), verbose=False)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(results, name):
    r = results[name]
    assert r["ok"], r


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["lang", "rank", "term", "weight"] and df.count() >= 0
