"""Statistics of many-to-many joins against the joined rows."""

import math
import random

import pandas as pd
import pytest

from entityloom.operators import factors as X


def close(a, b):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or math.isnan(b)
    return b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


def expect(joined, key, columns, pairs):
    out = {}
    for value, rows in joined.groupby(key):
        r = {"n_rows": float(len(rows))}
        for c in columns:
            s = rows[c].dropna()
            r |= {f"{c}_count": float(len(s)), f"{c}_sum": s.sum(), f"{c}_mean": s.mean() if len(s) else None}
            r |= {f"{c}_std": s.std() if len(s) > 1 else None, f"{c}_min": s.min() if len(s) else None, f"{c}_max": s.max() if len(s) else None}
        for a, b in pairs:
            both = rows[[a, b]].dropna()
            r[f"{a}_{b}_product_mean"] = (both[a] * both[b]).mean() if len(both) else None
            r[f"{a}_{b}_covariance"] = both[a].cov(both[b]) if len(both) > 1 else None
        out[value] = r
    return out


@pytest.mark.parametrize("centred", [False, True])
def test_chain_against_joined_rows(spark, centred):
    r = random.Random(3)
    some = lambda: None if r.random() < 0.2 else r.choice([0.0, -1.5, 2.0, 1000.25])
    a = [(r.choice([1, 2, 3, 9, None]), r.choice([7, 8]), some(), some()) for _ in range(40)]
    b = [(r.choice([1, 2, 3, 4, None]), some()) for _ in range(25)]
    c = [(r.choice([1, 2, 3, 5, None]), None if k else 4.0) for k in range(20)]
    fa, fb, fc = (
        spark.createDataFrame(a, "k int, g int, x double, y double"),
        spark.createDataFrame(b, "k int, `z` double"),
        spark.createDataFrame(c, "k int, w double"),
    )
    pairs = [("x", "y"), ("z", "x"), ("y", "w")]
    centres = {}
    if centred:
        for df, names in ((fa, ["x", "y"]), (fb, ["z"]), (fc, ["w"])):
            centres |= X.column_centres(df, names)
    chain = [
        X.factor(fa, ["g", "k"], ["x", "y"], pairs[:1], centres),
        X.factor(fb, ["k"], ["z"], centres=centres),
        X.factor(fc, ["k"], ["w"], centres=centres),
    ]
    rows = X.statistics(X.marginal(X.multiply_all(chain, pairs[1:]), ["g"])).collect()
    tables = [pd.DataFrame(t, columns=n).dropna(subset=["k"]) for t, n in ((a, list("kgxy")), (b, list("kz")), (c, list("kw")))]
    joined = tables[0].merge(tables[1], on="k").merge(tables[2], on="k")
    want = expect(joined, "g", ["x", "y", "z", "w"], pairs)
    assert {x["g"] for x in rows} == set(want) and len(rows) == len(want)
    for row in rows:
        for name, value in want[row["g"]].items():
            assert close(value, row[name]), (row["g"], name, value, row[name])


def test_a_key_of_a_billion_joined_rows(spark):
    one = lambda c: spark.range(1000).selectExpr("1L AS k", f"id * 1.0D AS {c}")
    f = X.multiply_all([X.factor(one(c), ["k"], [c]) for c in "xyz"], [("x", "z")])
    row = X.statistics(f).first()
    assert row["n_rows"] == 1e9 and row["x_mean"] == 499.5 and row["y_sum"] == 499.5 * 1e9
    # the values of x and z meet in all ways
    assert row["x_z_product_mean"] == 499.5**2 and abs(row["x_z_covariance"]) < 1e-3
    assert math.isclose(row["z_std"], math.sqrt((1000**2 - 1) / 12 * 1e9 / (1e9 - 1)), rel_tol=1e-12)


def test_centres_keep_the_digits_of_a_deviation(spark):
    df = spark.range(100).selectExpr("1 AS k", "1e9 + id AS x")
    plain = pd.Series([1e9 + i for i in range(100)])
    row = X.statistics(X.factor(df, ["k"], ["x"], centres=X.column_centres(df, ["x"]))).first()
    assert math.isclose(row["x_std"], plain.std(), rel_tol=1e-12) and math.isclose(row["x_mean"], plain.mean(), rel_tol=1e-15)


def test_a_column_of_one_value_does_not_vary(spark):
    keys = range(1, 31)
    left = spark.createDataFrame([(k, 7504.13 / k) for k in keys] + [(0, 0.3), (0, 0.5)], "k int, a double")
    right = spark.createDataFrame([(k, i * 0.7) for k in range(31) for i in range(101)], "k int, b double")
    centres = {"a": 0.1, "b": 0.2}
    whole = X.multiply(X.factor(left, ["k"], ["a"], centres=centres), X.factor(right, ["k"], ["b"], centres=centres), [("a", "b")])
    rows = {r["k"]: r for r in X.statistics(X.marginal(whole, ["k"])).collect()}
    assert [(rows[k]["a_std"], rows[k]["a_b_covariance"]) for k in keys] == [(0.0, 0.0)] * 30 and all(rows[k]["b_std"] > 0 for k in keys)
    assert rows[0]["a_std"] == pytest.approx(0.1, rel=1e-2) and rows[0]["a_b_covariance"] == pytest.approx(0, abs=1e-9)


def test_empty_tables_and_all_rows(spark):
    none = spark.createDataFrame([], "k int, x double")
    some = spark.createDataFrame([(1, 2.0), (1, None), (2, 5.0), (None, 9.0)], "k int, y double")
    assert X.column_centres(none, ["x"]) == {"x": 0.0} and X.column_centres(some, []) == {}
    f = X.multiply(X.factor(none, ["k"], ["x"]), X.factor(some, ["k"], ["y"]))
    assert X.statistics(f).count() == 0
    whole = X.statistics(X.marginal(f, [])).first()
    assert whole["n_rows"] == 0 and whole["y_mean"] is None and whole["x_sum"] == 0
    alone = X.statistics(X.marginal(X.factor(some, ["k"], ["y"]), [])).first()
    assert (alone["n_rows"], alone["y_count"], alone["y_sum"], alone["y_min"], alone["y_max"]) == (3, 2, 7, 2, 5)


def test_the_side_with_more_keys_may_be_either(spark):
    orders = X.factor(spark.createDataFrame([(1, 10), (2, 10), (3, 20)], "o int, c int"), ["o", "c"])
    lines = X.factor(spark.createDataFrame([(1, 1.0), (1, 3.0), (3, 5.0)], "o int, q double"), ["o"], ["q"])
    for f in (X.multiply(orders, lines), X.multiply(lines, orders)):
        got = {r["c"]: (r["n_rows"], r["q_mean"]) for r in X.statistics(X.marginal(f, ["c"])).collect()}
        assert got == {10: (2, 2.0), 20: (1, 5.0)}


def test_what_would_multiply_rows_is_refused(spark):
    df = spark.createDataFrame([(1, 1, 1, 1.0)], "k int, a int, b int, x double")
    left, right = X.factor(df, ["k", "a"], ["x"]), X.factor(df, ["k", "b"])
    for call in (
        lambda: X.multiply(left, right),
        lambda: X.multiply(X.marginal(left, ["a"]), X.marginal(right, ["b"])),
        lambda: X.multiply(left, X.factor(df, ["k"], ["x"])),
        lambda: X.multiply(left, X.marginal(right, ["k"]), [("x", "q")]),
        lambda: X.multiply_all([left, X.marginal(right, ["k"])], [("x", "q")]),
        lambda: X.factor(df, [], ["x"]),
        lambda: X.factor(df, ["x"], ["x"]),
        lambda: X.factor(df, ["k"], ["x"], [("x", "b")]),
        lambda: X.marginal(left, ["b"]),
    ):
        with pytest.raises(ValueError):
            call()
