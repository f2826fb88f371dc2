"""Every query with oracle SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import rows_of

SF = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    relation = duck.execute(ORACLES[name])
    columns = [d[0] for d in relation.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, relation.fetchall())


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 2


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())
