"""Every query against its SQL, row by row."""

import os

import pytest

import __spark_entry__ as entry_points
from tests.oracle import compare, duckdb_session

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duckdb_session(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, connection, name):
    assert compare(QUERIES[name](spark, FOLDER), connection, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert df.count() > 0
    assert len(set(df.columns)) == len(df.columns)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_whole_parent_tables_and_absent_parents(spark):
    replayed = QUERIES["replay_whole_tables"](spark, FOLDER)
    customers = spark.read.parquet(f"{FOLDER}/customer.parquet").selectExpr("c_custkey", "c_acctbal AS balance", "c_nationkey AS nation")
    met = replayed.join(customers, "c_custkey")
    assert met.filter("c_custkey % 2 = 1").count() > 0
    assert met.filter("c_acctbal <> balance OR c_nationkey <> nation").count() == 0
    assert replayed.join(customers, "c_custkey", "left_anti").filter("o_totalprice_orders_mean > 0").count() > 0
    rolled = QUERIES["rollup_general_unknown"](spark, FOLDER)
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet").selectExpr("o_orderkey AS l_orderkey", "o_custkey AS owner")
    assert rolled.join(orders, "l_orderkey").filter("NOT o_custkey <=> owner").count() == 0
    assert rolled.filter("l_orderkey < 0 AND o_custkey IS NULL").count() > 0 and rolled.filter("l_orderkey IS NULL").count() == 1


def test_entry(spark):
    df = entry_points.entry(spark)
    assert {"c_custkey", "target", "o_totalprice", "value"} <= set(df.columns)
    assert df.count() == df.select("c_custkey").distinct().count() > 0
