"""Correctness gate: every registered query against its DuckDB formulation
on the sf0.001 tables (the driver runs the same check at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from tallyspark.checks.compare import TABLES, _rows
from tallyspark.queries import all_queries

SMALL = "/root/testdata/sf0.001"
NAMES = sorted(all_queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql())
    assert len(NAMES) == 64


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _rows(df.columns, srows) == _rows(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["biz_date", "user_type", "refunded"]
    assert df.count() > 0
