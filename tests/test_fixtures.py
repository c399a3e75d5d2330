"""Hand-made edge cases with worked-out results."""

import math

import pytest
from pyspark.sql import functions as F

from entityloom.functions import scalars as S
from entityloom.functions.registry import PAIR_FUNCTIONS, canonical_name
from entityloom.operators import clean as K
from entityloom.operators import encode as E
from entityloom.operators import joins as J
from entityloom.operators import rollup as R
from entityloom.operators.columns import add_suffix, keep, split_label
from entityloom.operators.profile import low_variance, min_max_scale, summary_stats, target_profile
from entityloom.plans.replay import FeatureSpec, apply_specs, layers

INF = float("inf")


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_clean(spark):
    df = spark.createDataFrame(
        [(1, "XNA", 365243.0), (2, "XNA/XAP", 4.0), (3, None, None), (4, "ok", INF), (365243, "a", 8.0), (5, "it's \\ odd", math.nan)],
        "id long, s string, d double",
    )
    assert rows(K.clean(df, protect=["id"]), "id") == [
        (1, "", 6.0), (2, "", 4.0), (3, "", 6.0), (4, "ok", 6.0), (5, "it's \\ odd", 6.0), (365243, "a", 8.0),
    ]
    # without protection the key is masked like any other number
    assert K.clean(df, impute=None).filter("id IS NULL").count() == 1


def test_clean_quotes_in_sentinels(spark):
    df = spark.createDataFrame([("it's",), ("back\\slash",), ("x",)], "s string")
    cleaned = K.nullify_sentinels(df, texts=["it's", "back\\slash"], numbers=[])
    assert sorted(r["s"] for r in cleaned.collect()) == ["", "", "x"]


def test_fill_keeps_types_and_booleans(spark):
    df = spark.createDataFrame([(1, None, True, None)], "a int, b int, c boolean, d double")
    filled = K.fill_number(df, -1)
    assert filled.first() == (1, -1, True, -1.0)
    assert [t for _, t in filled.dtypes] == ["int", "int", "boolean", "double"]


def test_mean_of_missing_column_stays_missing(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id long, x double")
    assert rows(K.fill_mean(df, protect=["id"]), "id") == [(1, None), (2, None)]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(1.0, math.nan)], "a double, b double")
    assert K.nan_to_null(df).first() == (1.0, None)


PAIRS = [(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 0.0), (6.0, 2.0), (1.0, None)]


@pytest.mark.parametrize(
    "name, expected",
    [
        ("ratio_ieee", [INF, -INF, None, None, 3.0, None]),
        ("ratio_clamped", [1.0, -1.0, 0.0, None, 3.0, 1.0]),
        ("ratio_guarded", [1.0, -1.0, 0.0, None, 3.0, None]),
        ("ratio_null", [None, None, None, None, 3.0, None]),
        ("sum", [1.0, -1.0, 0.0, None, 8.0, None]),
        ("diff", [1.0, -1.0, 0.0, None, 4.0, None]),
        ("product", [0.0, 0.0, 0.0, None, 12.0, None]),
        ("norm", [1.0, 1.0, 0.0, None, math.hypot(6, 2), None]),
        ("angle", [math.pi / 2, -math.pi / 2, 0.0, None, math.atan2(6, 2), None]),
    ],
)
def test_pair_functions(spark, name, expected):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(PAIRS)], "i int, a double, b double")
    out = df.select("i", PAIR_FUNCTIONS[name](F.col("a"), F.col("b")).alias("x"))
    assert [r[1] for r in rows(out, "i")] == pytest.approx(expected, nan_ok=False)


def test_flags_and_text(spark):
    df = spark.createDataFrame([("Closed", 3), (None, None), ("Active", 4)], "s string, n int")
    out = df.select(
        S.flag_not_equal(F.col("s"), "Closed"), S.flag_equal(F.col("s"), "Closed"), S.as_text(F.col("n")), S.as_number(F.col("s"))
    )
    assert [tuple(r) for r in out.collect()] == [(0, 1, "3", None), (1, 0, "nan", None), (1, 0, "4", None)]


XS = [(1, 1.0), (1, 3.0), (2, 5.0), (2, INF), (3, 7.0)]


def test_infinity_in_a_block(spark):
    df = spark.createDataFrame(XS, "id long, x double")
    plain = R.feature_block(df, "id", "n")
    assert rows(plain.select("id", "x", "x_max", "x_min"), "id") == [(1, 2.0, 3.0, 1.0), (2, INF, INF, 5.0), (3, 7.0, 7.0, 7.0)]
    filled = R.feature_block(df, "id", "n", after="mean")
    got = rows(filled.select("id", "x", "x_max", "x_min", "x_mean"), "id")
    assert got == [
        (1, 2.0, 3.0, 1.0, 2.0),
        (2, 4.5, pytest.approx(13 / 3), 5.0, pytest.approx(11 / 3)),
        (3, 7.0, 7.0, 7.0, 7.0),
    ]
    late = K.clean(plain, protect=["id"])
    assert rows(late.select("id", "x", "x_max", "x_min"), "id") == [(1, 2.0, 3.0, 1.0), (2, 4.5, 5.0, 5.0), (3, 7.0, 7.0, 7.0)]


def test_block_zero(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None), (2, None)], "id long, x double")
    block = R.feature_block(df, "id", "n", after="zero")
    assert rows(block.select("id", "n", "x", "x_mean", "x_min", "x_max"), "id") == [(1, 2, 1.0, 2.0, 2.0, 2.0), (2, 1, 0.0, 0.0, 0.0, 0.0)]


LOANS = [(10, 1, 1.0), (10, 1, 3.0), (11, 1, 10.0), (12, 2, 2.0), (12, 2, 4.0), (12, 2, 6.0)]


@pytest.mark.parametrize("functional", [True, False])
def test_two_levels(spark, functional):
    df = spark.createDataFrame(LOANS, "loan long, cust long, v double")
    out = R.rollup_two_level(df, "loan", "cust", "t", stats=R.ROLLUP_STATS, functional=functional)
    names = [f"v_t_{s}" for s in R.ROLLUP_STATS]
    got = rows(out.select("cust", *names), "cust")
    assert got[0] == pytest.approx((1, 5 / 3, 14 / 3, 4.0, 16 / 3, 6.0))
    assert got[1] == (2, 3.0, 4.0, 2.0, 6.0, 12.0)


def test_two_levels_with_parents_table(spark):
    df = spark.createDataFrame([(l, v) for l, _, v in LOANS], "loan long, v double")
    parents = spark.createDataFrame([(10, 1), (11, 1), (12, 2)], "loan long, cust long")
    out = R.rollup_two_level(df, "loan", "cust", "t", ["v"], parents=parents)
    assert rows(out.select("cust", "v_t_max"), "cust") == [(1, pytest.approx(16 / 3)), (2, 6.0)]


@pytest.mark.parametrize("functional", [True, False])
def test_rows_without_a_loan_stay(spark, functional):
    df = spark.createDataFrame([(10, 1, 1.0), (None, 1, 9.0), (None, 2, 9.0)], "loan long, cust long, v double")
    if not functional:
        general = R.rollup_general(df, "loan", "cust", "t", stats=["max"])
        assert sorted(map(str, map(tuple, general.collect()))) == ["(10, 1, 1, 1.0)", "(None, 1, 1, None)", "(None, 2, 1, None)"]
    out = R.rollup_two_level(df, "loan", "cust", "t", stats=["max"], functional=functional)
    assert rows(out, "cust") == [(1, 1.0), (2, None)]


def test_shared_loan(spark):
    # loan 10 belongs to two customers: its statistics are made over both
    df = spark.createDataFrame([(10, 1, 1.0), (10, 2, 3.0), (10, 2, 5.0), (11, 2, 9.0)], "loan long, cust long, v double")
    out = R.rollup_general(df, "loan", "cust", "t", stats=["average"])
    assert rows(out, "loan", "cust") == [(10, 1, 1, 3.0), (10, 2, 2, 3.0), (11, 2, 1, 9.0)]
    assert rows(R.rollup_two_level(df, "loan", "cust", "t", stats=["average"]), "cust") == [(1, 3.0), (2, 5.0)]


def test_one_hot(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "b")], "id long, c string")
    values = E.fit_values(df)
    coded = E.one_hot(df, values, ["id"])
    assert coded.columns == ["id", "feature_c_a", "feature_c_b", "feature_c_nan"]
    assert rows(coded, "id") == [(1, 0, 1, 0), (2, 1, 0, 0), (3, 0, 0, 1), (4, 0, 1, 0)]
    beside = E.append_indicators(df, values, protect=["id"])
    assert beside.columns == ["id", "c", "feature_c_", "feature_c_a", "feature_c_b"]
    assert rows(beside, "id")[2] == (3, "", 1, 0, 0)
    # a value that was not there in fitting has no column
    assert rows(E.one_hot(spark.createDataFrame([(1, "z")], "id long, c string"), values), "id") == [(1, 0, 0, 0)]


def test_one_hot_names(spark):
    df = spark.createDataFrame([("a b",), ("a-b",), ("it's",)], "c string")
    coded = E.one_hot(df, E.fit_values(df))
    assert coded.columns == ["feature_c_a_b", "feature_c_a_b_2", "feature_c_it_s", "feature_c_nan"]
    assert sorted(map(tuple, coded.collect())) == [(0, 0, 1, 0), (0, 1, 0, 0), (1, 0, 0, 0)]


def test_too_many_values_is_an_error(spark):
    df = spark.range(20).selectExpr("CAST(id AS STRING) AS c")
    with pytest.raises(ValueError, match="more than 10 values"):
        E.fit_values(df, max_values=10)


def test_label_codes(spark):
    df = spark.createDataFrame([(1, "b", 5.0), (2, "a", None), (3, None, 1.0)], "id long, c string, x double")
    assert rows(E.label_encode(df, ["id"]), "id") == [(1, 2, 5.0), (2, 1, 0.0), (3, 0, 1.0)]
    assert [r[1] for r in rows(E.label_encode(df, ["id"], missing="nan"), "id")] == [1, 0, 2]
    codes = E.fit_codes(df, spark.createDataFrame([(9, "aa", 0.0)], df.schema))
    assert [r[1] for r in rows(codes.transform(df), "id")] == [3, 1, 0]
    unseen = spark.createDataFrame([(1, "zz", 0.0)], df.schema)
    assert rows(codes.transform(unseen), "id") == [(1, None, 0.0)]


def test_label_codes_beyond_broadcast(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"v{i % 7}" if i % 5 else None) for i in range(100)], "id long, c string")
    expected = rows(E.label_encode(df, ["id"]), "id")
    monkeypatch.setattr(E, "BROADCAST_BYTES", 0)
    assert rows(E.label_encode(df, ["id"]), "id") == expected


def test_describe(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    assert tuple(summary_stats(df).first()) == ("x", 4, 4.0, pytest.approx(4.082483), 1.0, 1.75, 2.5, 4.75, 10.0)
    empty = summary_stats(df.filter("x > 99")).first()
    assert empty["count"] == 0 and empty["p50"] is None


def test_missing_keys(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k long, x string")
    right = spark.createDataFrame([(1, "c"), (None, "d")], "k long, y string")
    assert left.join(right, ["k"]).count() == 1
    assert sorted(map(tuple, J.join_null_safe(left, right, ["k"]).collect()), key=str) == [(1, "a", "c"), (None, "b", "d")]
    assert R.group_means(left.withColumn("v", F.lit(1.0)), "k").count() == 1
    full = J.join_null_safe(left, right.filter("k IS NULL").unionAll(spark.createDataFrame([(7, "e")], right.schema)), ["k"], "full")
    assert sorted(map(tuple, full.collect()), key=str) == [(1, "a", None), (7, None, "e"), (None, "b", "d")]


def test_single_row_group(spark):
    df = spark.createDataFrame([(1, 5.0)], "k long, x double")
    assert R.group_stats(df, "k", {"x": ["std"]}).first() == (1, None)


def test_sum_of_missing_is_zero(spark):
    df = spark.createDataFrame([(1, None)], "k long, x double")
    assert R.group_stats(df, "k", {"x": ["sum", "count", "max"]}).first() == (1, 0.0, 0, None)


def test_suffixes(spark):
    a = spark.createDataFrame([(1, 2.0)], "id long, v double")
    b = spark.createDataFrame([(1, 3.0)], "id long, v double")
    assert J.join_with_suffixes(a, b, ["id"], ("pos_", "prev_")).columns == ["id", "vpos_", "vprev_"]
    assert J.join_with_suffixes(a, b, ["id"], ("", "_max")).columns == ["id", "v", "v_max"]
    with pytest.raises(ValueError, match="equal names"):
        J.join_with_suffixes(a, b, ["id"], ("", ""))
    with pytest.raises(ValueError, match="equal names"):
        J.join_with_suffixes(a.withColumn("v_max", F.lit(1)), b, ["id"], ("", "_max"))


def test_chained_spec(spark):
    df = spark.createDataFrame([(3.0, 2.0)], "a double, b double")
    specs = [FeatureSpec("f_0", "product", ("a", "b")), FeatureSpec("f_1", "atan2_feature_creator", ("f_0", "a"))]
    assert apply_specs(df, specs).first() == (3.0, 2.0, 6.0, pytest.approx(math.atan2(6, 3)))
    assert [[s.name for s in layer] for layer in layers(df.columns, specs)] == [["f_0"], ["f_1"]]
    with pytest.raises(ValueError, match="f_1: unknown input f_0"):
        apply_specs(df, specs[::-1])
    with pytest.raises(ValueError, match="the name is taken"):
        apply_specs(df, [FeatureSpec("a", "sum", ("a", "b"))])
    with pytest.raises(ValueError, match="unknown feature function"):
        apply_specs(df, [FeatureSpec("x", "no_such", ("a", "b"))])
    assert canonical_name("divide_feature_creator") == "ratio_guarded"


def test_group_features_keep_all_rows(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", 3.0), (3, None, 5.0)], "id long, g string, x double")
    specs = [FeatureSpec("s", "std_feature_creator", ("g", "x")), FeatureSpec("n", "count_feature_creator", ("g",))]
    got = rows(apply_specs(df, specs).select("id", "s", "n"), "id")
    assert got == [(1, pytest.approx(math.sqrt(2)), 2), (2, pytest.approx(math.sqrt(2)), 2), (3, None, None)]


def test_keep_names_must_be_a_list(spark):
    df = spark.createDataFrame([(1, 2.0)], "SK_ID_CURR long, CURR double")
    with pytest.raises(TypeError):
        add_suffix(df, "_mean", "SK_ID_CURR")
    with pytest.raises(TypeError):
        R.reduce_to_key(df, "SK_ID_CURR", "SK_ID_CURR")
    assert add_suffix(df, "_mean", ["SK_ID_CURR"]).columns == ["SK_ID_CURR", "CURR_mean"]


def test_reduce_to_key(spark):
    df = spark.createDataFrame([(1, 0, 2.0), (1, 0, 4.0), (2, 1, None)], "k long, y int, x double")
    out = R.reduce_to_key(df, "k", ["k"], carry=["y"])
    assert rows(out, "k") == [(1, 0, 3.0), (2, 1, None)]
    assert out.columns == ["k", "y", "x_int_mean"]


def test_column_choice(spark):
    df = spark.createDataFrame([(1, 0, "a")], "k long, y int, s string")
    with pytest.raises(ValueError, match="no such columns: z"):
        keep(df, ["k", "z"])
    assert keep(df, ["s", "z", "k"], strict=False).columns == ["s", "k"]
    assert split_label(df, "k", "y") == (["s"], "y")


def test_target_profile_and_scaling(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 0), (None, 2, None)], "c string, n int, target int")
    got = {(r["column"], r["value"]): (r["target_mean"], r["target_count"]) for r in target_profile(df, "target").collect()}
    assert got == {("c", "a"): (0.5, 2), ("n", "1"): (1.0, 1), ("n", "2"): (0.0, 1)}
    flat = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, y double")
    assert rows(min_max_scale(flat, ["x", "y"]), "x") == [(0.0, 0.0), (1.0, 0.0)]
    assert [r["column"] for r in low_variance(flat, ["x", "y"]).collect()] == ["y"]
