"""Every registered query against its SQL on the given tables."""

import pytest

import __spark_entry__ as entry_module
import compare

QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, con, name):
    rows, problems = compare.differences(QUERIES[name](spark, sf_dir), con, ORACLES[name])
    assert not problems, problems
    assert rows > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_returns_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and "ring_id" in df.columns
