"""Every registered query with a SQL oracle gives the same rows as DuckDB on the same tables."""

import pytest

from helpers import SF_ORACLE
from helpers import same_result

import __spark_entry__ as entry_mod

ORACLES = entry_mod.oracle_sql()
QUERIES = entry_mod.queries()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["n_test"] > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_ORACLE).toPandas()
    want = duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns), (list(got.columns), list(want.columns))
    assert len(got) == len(want)
    assert same_result(got, want)
