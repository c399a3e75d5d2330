"""Physical plans: what is read, how often it is shuffled, and that no Python runs."""

import re

import pytest
from pyspark.sql import functions as F

from entityloom.catalog import QUERIES
from entityloom.operators import rollup as R

SF = "/root/testdata/sf0.001"
MODEL_QUERIES = {"gbt_score", "gbt_importance", "gbt_summary", "feature_search", "pca_features"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODEL_QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_one_shuffle_per_rollup(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    assert shuffles(R.group_stats(orders, "o_custkey", {"o_totalprice": list(R.ROLLUP_STATS)}, "n")) == 1
    assert shuffles(R.feature_block(orders, "o_custkey", "n", ["o_totalprice"])) == 1
    # loan level, then customer level
    assert shuffles(R.rollup_two_level(orders, "o_orderkey", "o_custkey", "t", ["o_totalprice"], functional=True)) == 2


def test_rollup_feeds_its_join_without_another_shuffle(spark, no_broadcast):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    customer = spark.read.parquet(f"{SF}/customer.parquet")
    block = R.feature_block(orders.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "n", ["o_totalprice"])
    # one for the orders, one for the customers
    assert shuffles(customer.join(block, "c_custkey", "left")) == 2


def test_scan_reads_only_what_is_used(spark):
    text = plan(QUERIES["group_std"](spark, SF))
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>", text)
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in text


def test_hot_keys_are_not_shuffled(spark, no_broadcast):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_tax")
    plain = plan(R.aggregate_back(lines, "l_orderkey", {"l_tax": ["max"]}))
    assert "Union" not in plain and "BroadcastHashJoin" not in plain
    hot = plan(R.aggregate_back(lines, "l_orderkey", {"l_tax": ["max"]}, hot_rows=10))
    warm = hot[hot.index("Union") : hot.index("SortMergeJoin")]
    # the rows of hot keys meet their facts where they are
    assert "BroadcastHashJoin" in warm
    assert hot.count("Exchange hashpartitioning") == 3


def test_global_means_are_planned_once(spark):
    text = plan(QUERIES["assemble_wide"](spark, SF))
    assert len(re.findall(r"Subquery subquery#", text)) <= 2


def test_splitting_a_union_reads_one_side(spark):
    from entityloom.operators.joins import union_tagged, untag

    customer = spark.read.parquet(f"{SF}/customer.parquet")
    orders = spark.read.parquet(f"{SF}/orders.parquet").select(F.col("o_custkey").alias("c_custkey"))
    one = untag(union_tagged("part", a=customer, b=orders), "part", "b")
    assert "customer.parquet" not in plan(one)


@pytest.mark.parametrize(("keys", "scans"), [(["o_custkey"], 3), (["o_custkey", "o_orderstatus"], 3)])
def test_group_features_share_their_grouping(spark, keys, scans):
    from entityloom.plans.replay import FeatureSpec, apply_specs

    orders = spark.read.parquet(f"{SF}/orders.parquet").withColumn("twice", F.col("o_totalprice") * 2)
    specs = [FeatureSpec(f"f{i}", "group_std", (keys[i % len(keys)], ["o_totalprice", "twice"][i % 4 // 2])) for i in range(10)]
    wide = apply_specs(orders, specs)
    # the facts, the rows with a key, and a scan with a pushed filter for those without
    assert len(re.findall(r"FileScan parquet", plan(wide).split("Initial Plan")[-1])) <= scans
    assert wide.count() == orders.count()
