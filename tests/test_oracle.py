"""Each query with a SQL form gives the same rows in DuckDB, on the smallest tables."""

import math
import os

import duckdb
import pytest

from labelloom.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return [plain(x) for x in value] if isinstance(value, (list, tuple)) else value


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{DATA}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    cur = duck.execute(ORACLE_SQL[name])
    at = [[d[0] for d in cur.description].index(c) for c in columns]
    assert got == sorted(repr([plain(r[i]) for i in at]) for r in cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 1
