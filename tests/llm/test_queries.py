"""Every query with a SQL counterpart against it, and the others for rows and columns."""

import os

import duckdb
import pytest

import corpus_pipeline
from corpora import docs, nothing  # noqa: F401
from stardw.llm import registry

TESTDATA = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.statements()


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "conversations", "labels", "embeddings"):
        con.execute(f"create view {table} as select * from '{TESTDATA}/{table}.parquet'")
    return con


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_like_sql(spark, engine, name):
    df = QUERIES[name](spark, TESTDATA)
    wanted = engine.execute(SQL[name])
    names = [c[0] for c in wanted.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(str, (tuple(r) for r in df.select(*names).collect()))) == sorted(map(str, wanted.fetchall()))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows(spark, engine, name):
    table = "pages" if "html" in name else "embeddings" if "whitening" in name else "documents"
    n = engine.execute(f"select count(*) from {table}").fetchone()[0] * (8 if "whitening" in name else 1)
    assert QUERIES[name](spark, TESTDATA).count() == n


def stages(spark, start):
    at = start
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, TESTDATA)
        yield name, at


def test_pipeline_stages(spark):
    start = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    before = start.count()
    for name, at in stages(spark, start):
        n = at.count()
        assert 0 < n <= before
        before = n
        if name != corpus_pipeline.STAGES[-1][0]:
            assert at.schema == start.schema
    ran = corpus_pipeline.run(spark, TESTDATA).collect()
    assert sorted(map(tuple, ran)) == sorted(map(tuple, at.collect()))


@pytest.mark.parametrize("kind", ["docs", "nothing"])
def test_pipeline_of_edge_rows(spark, request, kind):
    start = request.getfixturevalue(kind)
    for _, at in stages(spark, start):
        at.collect()
