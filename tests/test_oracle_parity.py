"""Every registered query with an oracle matches DuckDB on the sf0.001 tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import duck, same

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_dir, con, name):
    df = entry.queries()[name](spark, sf_dir)
    same(df, con, ORACLES[name])


def test_every_query_registered_has_a_callable():
    qs = entry.queries()
    assert len(qs) >= 60
    assert set(ORACLES) <= set(qs)


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) > 0
    assert "n_rated" in rows[0].asDict()
