"""Every registered query against its SQL counterpart, on the smallest tables."""

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import TESTDATA
from stardw import oracle, queries

TABLES = "region nation customer supplier part orders lineitem".split()
SQL = oracle.statements()
QUERIES = queries.queries()


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{TESTDATA}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def table(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows),
                  key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_a_counterpart():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, engine, name):
    df = QUERIES[name](spark, TESTDATA)
    cursor = engine.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert table(df.collect(), df.columns) == table(cursor.fetchall(), names)


def test_entry(spark):
    assert entry.entry(spark).count() == 20
