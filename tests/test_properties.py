"""Laws that must hold for any data, and hot keys against ordinary ones."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from entityloom.operators import joins as J
from entityloom.operators import rollup as R
from entityloom.operators.encode import fit_values
from entityloom.operators.ordering import in_top, number_rows, running_sums, sample_rows, top
from entityloom.operators.quantile import exact_percentiles, order_statistics
from entityloom.operators.skew import attach_by_key, expand_left, hot_hashes
from entityloom.operators.split import hash_bucket, with_hold_out, with_ordered_hold_out
from entityloom.plans.replay import FeatureSpec, apply_specs

SF = "/root/testdata/sf0.001"


def bag(df):
    return sorted(map(str, map(tuple, df.select(*sorted(df.columns)).collect())))


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{SF}/orders.parquet")


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, some without a key, and copies of rows."""
    rng = random.Random(5)
    data = []
    for i in range(900):
        key = 7 if i % 3 == 0 else (None if i % 50 == 1 else rng.randrange(40))
        data.append((key, rng.randrange(6), float(rng.randrange(10))))
    return spark.createDataFrame(data + data[:100], "k long, p long, x double")


def test_rollup_ignores_order_and_partitions(orders):
    stats = {"o_totalprice": ["count", "min", "max"]}
    expected = bag(R.group_stats(orders, "o_custkey", stats))
    assert bag(R.group_stats(orders.orderBy(F.rand(1)).repartition(17), "o_custkey", stats)) == expected
    assert bag(R.group_stats(orders.coalesce(1), "o_custkey", stats)) == expected


def test_shares_sum_to_one(orders):
    values = fit_values(orders, ["o_orderpriority"])
    shares = R.category_share(orders, "o_custkey", values)
    total = sum(F.col(c) for c in shares.columns if c.startswith("feature_o_orderpriority"))
    assert shares.select(F.max(F.abs(total - 1))).first()[0] < 1e-12


def test_group_sizes_cover_rows_with_a_key(skewed):
    sizes = R.group_stats(skewed, "k", {}, "n").agg(F.sum("n")).first()[0]
    assert sizes == skewed.filter("k IS NOT NULL").count()


@pytest.mark.parametrize("hot_rows", [1, 30, 300, 10**9])
@pytest.mark.parametrize("keep_missing", [True, False])
def test_hot_keys_change_nothing(skewed, hot_rows, keep_missing):
    stats = {"x": ["mean", "min", "max", "std"]}
    backed = R.aggregate_back(skewed, "k", stats, keep_missing=keep_missing, hot_rows=hot_rows)
    groups = R.group_stats(skewed, "k", stats, "group_rows")
    expected = skewed.join(groups, "k", "left" if keep_missing else "inner")
    assert bag(backed) == bag(expected.select(*backed.columns))


@pytest.mark.parametrize("hot_rows", [1, 100, 10**9])
def test_lookup_and_expand(spark, skewed, hot_rows):
    base = spark.range(60).selectExpr("id AS k", "id * 2 AS y")
    for how in ("inner", "left"):
        got = attach_by_key(skewed, base.filter("k < 20"), ["k"], how, hot_rows)
        assert bag(got) == bag(skewed.join(base.filter("k < 20"), "k", how))
    assert bag(expand_left(base, skewed, "k", hot_rows=hot_rows)) == bag(base.join(skewed, "k", "left"))
    few = base.filter("k > 3").unionAll(spark.createDataFrame([(None, 5)], "k long, y long"))
    assert bag(expand_left(few, skewed, "k", True, hot_rows)) == bag(few.join(skewed, "k", "full"))


def test_attach_rejects_other_joins(skewed):
    with pytest.raises(ValueError):
        attach_by_key(skewed, skewed, ["k"], "full")


@pytest.mark.parametrize("hot_rows", [1, 10**9])
def test_attach_across_number_types(spark, skewed, hot_rows):
    facts = spark.range(40).selectExpr("CAST(id AS INT) AS k", "id * 3 AS y")
    got = attach_by_key(skewed, facts, ["k"], "inner", hot_rows)
    assert bag(got) == bag(skewed.join(facts.withColumn("k", F.col("k").cast("long")), "k"))
    with pytest.raises(ValueError, match="string on the other"):
        attach_by_key(skewed, facts.withColumn("k", F.col("k").cast("string")), ["k"])


def test_hot_keys_are_found(spark, skewed):
    known = skewed.filter("k IS NOT NULL")
    assert hot_hashes(known, "xxhash64(k)", 250, 100) == [spark.range(1).selectExpr("xxhash64(7L)").first()[0]]
    assert hot_hashes(known, "xxhash64(k)", 10**9, 100) == []
    assert hot_hashes(known.filter("k > 99"), "xxhash64(k)", 1, 100) == []


def test_back_then_distinct_is_the_group(orders):
    backed = R.aggregate_back(orders, "o_custkey", {"o_totalprice": ["mean"]}, "n")
    distinct = backed.select("o_custkey", "n", "o_totalprice_mean").distinct()
    assert bag(distinct) == bag(R.group_stats(orders, "o_custkey", {"o_totalprice": ["mean"]}, "n"))


def test_rollup_forms_agree(skewed):
    # within a parent, made functional: loan = k * 10 + p
    loans = skewed.withColumn("loan", F.col("k") * 10 + F.col("p"))
    one = R.rollup_two_level(loans, "loan", "k", "t", ["x"], functional=True)
    two = R.rollup_two_level(loans, "loan", "k", "t", ["x"], functional=False)
    parents = loans.select("loan", "k").distinct()
    three = R.rollup_two_level(loans.drop("k"), "loan", "k", "t", ["x"], parents=parents.na.drop())
    for other in (two, three):
        joined = one.alias("a").join(other.alias("b"), "k")
        gaps = [F.max(F.abs(F.col(f"a.`{c}`") - F.col(f"b.`{c}`"))) for c in one.columns if c != "k"]
        assert joined.count() == one.count() == other.count()
        assert max(joined.agg(*gaps).first()) < 1e-9


def test_fold_outer_equals_full_joins(spark):
    a = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "k long, a int")
    b = spark.createDataFrame([(2, 5), (3, 6)], "k long, b int")
    c = spark.createDataFrame([(None, 7), (1, 8)], "k long, c int")
    expected = bag(J.fold_outer_rows([a, b, c], ["k"]))
    assert bag(J.fold_outer([a, b, c])) == expected
    with pytest.raises(ValueError, match="share value columns"):
        J.fold_outer([a, a], ["k"])


def test_chain_equals_the_exploded_join(spark, skewed):
    other = spark.createDataFrame([(7, 1.0), (7, 2.0), (3, 5.0), (None, 1.0)], "k long, y double")
    exploded = skewed.join(other, "k").join(skewed.select("k", F.col("p").alias("q")), "k")
    expected = exploded.groupBy("k").agg(
        F.count(F.lit(1)).cast("double").alias("chain_rows"),
        F.sum("x").alias("chain_sum_x"),
        F.sum("y").alias("chain_sum_y"),
    )
    blocks = [
        (J.chain_block(skewed, "k", "n1", ["x"]), "n1"),
        (J.chain_block(other, "k", "n2", ["y"]), "n2"),
        (J.chain_block(skewed, "k", "n3", []), "n3"),
    ]
    assert bag(J.chain_totals(blocks, "k")) == bag(expected)


def test_replay_equals_inlined_expressions(orders):
    specs = [
        FeatureSpec("f_0", "product", ("o_totalprice", "o_custkey")),
        FeatureSpec("f_1", "ratio_clamped", ("f_0", "o_orderkey")),
        FeatureSpec("f_2", "sum", ("f_1", "f_0")),
    ]
    inlined = orders.selectExpr(
        "o_orderkey",
        "o_totalprice * o_custkey / greatest(1, o_orderkey) + o_totalprice * o_custkey AS f_2",
    )
    assert bag(apply_specs(orders, specs).select("o_orderkey", "f_2")) == bag(inlined)


def test_positions_and_running_sums(spark):
    rng = random.Random(3)
    data = [(i, f"v{rng.random():.6f}", rng.randrange(5)) for i in range(500)]
    df = spark.createDataFrame(data, "id long, v string, n int").repartition(9)
    order = sorted(data, key=lambda r: (r[1], r[0]))
    positions = {r["id"]: r["pos"] for r in number_rows(df, ["v", "id"], "pos").collect()}
    assert positions == {r[0]: i for i, r in enumerate(order)}
    sums = {r["id"]: r["s"] for r in running_sums(df, ["v", "id"], {"n": "s"}).collect()}
    assert sums == {r[0]: sum(q[2] for q in order[:i]) for i, r in enumerate(order)}


def test_positions_of_nothing(spark):
    assert number_rows(spark.createDataFrame([], "v string"), ["v"], "pos").count() == 0


def test_top_and_sample(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 3.0), ("d", None)], "name string, f double")
    assert [r["name"] for r in top(df, "f", 2, ["name"]).collect()] == ["b", "c"]
    assert in_top(df, "f", 2, ["name"], "name", "c").first()[0] == 1
    assert in_top(df, "f", 2, ["name"], "name", "a").first()[0] == 0
    assert in_top(df, "f", 2, ["name"], "name", "none").first()[0] == 0
    keys = spark.range(5000)
    sample = {r["id"] for r in sample_rows(keys, "id", 50).collect()}
    assert sample == {r["id"] for r in sample_rows(keys.repartition(7), "id", 50).collect()}
    assert sample == set(sorted(range(5000), key=lambda k: (hashlib.md5(str(k).encode()).hexdigest(), k))[:50])
    assert len({k % 1009 for k in sample}) > 40
    assert sample_rows(spark.createDataFrame([(2**63 - 1,)], "id long"), "id", 1).count() == 1


def exact(values, p):
    at = p * (len(values) - 1)
    low, high = values[math.floor(at)], values[math.ceil(at)]
    return low + (at - math.floor(at)) * (high - low)


@pytest.mark.parametrize("gather_rows", [1, 10, 100_000])
def test_quantiles_against_sorting(spark, gather_rows):
    rng = random.Random(11)
    data = []
    for i in range(3000):
        data.append(
            (
                rng.gauss(0, 1) * 10 ** rng.randrange(-200, 200),  # many magnitudes
                rng.choice([0.0, 0.0, 0.0, 1.0, 2.0]),  # few values
                2**60 + rng.randrange(1000),  # longs that a double cannot tell apart
                None if i % 2 else float(i % 7),
            )
        )
    df = spark.createDataFrame(data, "a double, b double, c long, d double").repartition(5)
    probabilities = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = exact_percentiles(df, ["a", "b", "d"], probabilities, gather_rows)
    for n, name in ((0, "a"), (1, "b"), (3, "d")):
        values = sorted(r[n] for r in data if r[n] is not None)
        assert got[name] == pytest.approx([exact(values, p) for p in probabilities], rel=1e-12)
    longs = sorted(r[2] for r in data)
    assert order_statistics(df, {"c": [0, 1, 1499, 2999]}, gather_rows)["c"] == [longs[i] for i in (0, 1, 1499, 2999)]
    with pytest.raises(ValueError, match="outside"):
        order_statistics(df, {"c": [3000]})


def test_splits(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    ordered = with_ordered_hold_out(df.repartition(6), "k", 0.9)
    assert ordered.filter("is_validation").agg(F.min("k"), F.count("k")).first() == (900, 100)
    hashed = with_hold_out(df, hash_bucket(["k"], seed=1), 0.10)
    held = {r["k"] for r in hashed.filter("is_validation").collect()}
    assert 60 < len(held) < 140
    fine = with_hold_out(df, hash_bucket(["k"], 1000), 0.004, buckets=1000)
    assert fine.count() == 1000 and fine.filter("is_validation").count() < 20
    with pytest.raises(ValueError):
        with_hold_out(df, hash_bucket(["k"]), 0.004)
    missing = with_hold_out(spark.createDataFrame([(None,)], "k long"), F.col("k"), 0.5)
    assert missing.first()["is_validation"] is False
    again = with_hold_out(df.repartition(3), hash_bucket(["k"], seed=1), 0.10)
    assert held == {r["k"] for r in again.filter("is_validation").collect()}


def test_union_and_apart_again(spark):
    train = spark.createDataFrame([(1, 0)], "k long, y int")
    test = spark.createDataFrame([(2,)], "k long")
    both = J.union_tagged("part", train=train, test=test)
    assert sorted(map(tuple, both.collect())) == [(1, 0, "train"), (2, None, "test")]
    assert tuple(J.untag(both, "part", "test").first()) == (2, None)
    assert bag(J.in_keys(both, test, "k")) == bag(both.filter("k = 2"))


def test_gathered_values_are_bounded_over_all_columns(spark, monkeypatch):
    from entityloom.operators import quantile

    gathered = []
    plain = quantile._gathered
    monkeypatch.setattr(quantile, "_gathered", lambda df, b: gathered.append(sum(x.inside for x in {y.span: y for y in b}.values())) or plain(df, b))
    columns = [f"c{i}" for i in range(30)]
    df = spark.range(2000).select(*[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(100_000)).alias(c) for i, c in enumerate(columns)]).cache()
    got = quantile.order_statistics(df, {c: [500, 1999] for c in columns}, 300)
    rows = df.collect()
    for c in columns:
        values = sorted(r[c] for r in rows)
        assert got[c] == [values[500], values[1999]]
    assert not gathered or max(gathered) <= 300
