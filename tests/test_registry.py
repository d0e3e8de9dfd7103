"""Every registered query against its SQL oracle (DuckDB) on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, compare

#: Keys of the optional training-data part have their own tests.
KEYS = sorted(k for k in queries() if k.startswith("q"))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield c
    c.close()


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = queries()[key](spark, SF_SMALL)
    problems, n_spark, n_sql = compare(df, con, oracle_sql()[key])
    assert not problems, problems
    assert n_spark == n_sql


def test_entry_smoke(spark):
    df = entry(spark)
    first = df.schema
    assert df.count() > 0
    assert entry(spark).schema == first
