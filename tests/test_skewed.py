"""The order queries on tables in which one key holds a third of the rows, with the broadcast
limit off and the bounds of hot keys low, so that every join takes its large-table way."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import TESTDATA
from stardw.operators import skew
from test_oracle import TABLES, table

NAMES = ["stage_order_lines", "stage_client", "stage_produit", "fact_sales", "price_at_date",
         "discount_at_date", "asof_client_version", "q14_eta_squared", "q4_group_margin",
         "q8_top_reps", "q11_top_customers", "fact_reload_idempotent", "dq_orphans",
         "order_total_rollup"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    made = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    changed = {
        "lineitem": "select * replace (case when i % 3 = 0 then 11 else l_orderkey end as "
                    "l_orderkey, case when i % 3 = 1 then 7 else l_partkey end as l_partkey) "
                    "from (select *, row_number() over () i from src)",
        "orders": "select * replace (case when o_orderkey % 3 = 0 then 5 else o_custkey end as "
                  "o_custkey) from src"}
    for name in TABLES:
        con.execute(f"create or replace view src as select * from '{TESTDATA}/{name}.parquet'")
        select = changed.get(name, "select * from src")
        columns = ", ".join(r[0] for r in con.execute("describe src").fetchall())
        con.execute(f"copy (select {columns} from ({select})) to '{made}/{name}.parquet'")
    return str(made)


@pytest.fixture(scope="module")
def engine(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def large(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    kept = skew.hot_keys.__kwdefaults__["min_rows"]
    skew.hot_keys.__kwdefaults__["min_rows"] = 300
    rows, skew.salts_for.__defaults__ = skew.salts_for.__defaults__, (200,)
    yield
    skew.hot_keys.__kwdefaults__["min_rows"] = kept
    skew.salts_for.__defaults__ = rows
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_the_hot_keys_are_found(spark, folder, large):
    from stardw.sources.retail_parquet import RetailParquet
    source = RetailParquet(spark, folder)
    assert list(source.hot_orders()) == [11] and list(source.hot_products()) == [7]
    assert list(source.hot_clients()) == [5]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, folder, engine, large, name):
    df = entry.queries()[name](spark, folder)
    cursor = engine.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert table(df.collect(), df.columns) == table(cursor.fetchall(), names)
