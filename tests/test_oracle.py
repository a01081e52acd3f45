"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry
from tools.oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    res = duck.execute(sql)
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    assert rows_of(cols, rows) == rows_of(ocols, res.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns == ["category", "n_train", "n_eval"]
