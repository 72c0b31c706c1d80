"""Every registered query against its SQL oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from ratebridge.plans import catalogue
from ratebridge.testing import SF_SMALL, diff_results, duckdb_connection

# The optional queries have tests of their own.
QUERIES = catalogue.queries()
ORACLES = catalogue.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLES[name])
    problems = diff_results(df.columns, rows, rel.columns, rel.fetchall())
    assert not problems, problems


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "effective_margin_new" in df.columns
