"""Profiles that are kept and merged."""

import math
import random

import pytest
from pyspark.sql import functions as F

from entityloom.operators import sketches as K
from entityloom.sources.sinks import staged


def told(df, *by):
    return {tuple(r[c] for c in (*by, "column")): r for r in K.read_profile(df).collect()}


def test_parts_merge_to_the_whole(spark, tmp_path):
    r = random.Random(5)
    rows = [(i % 7, r.gauss(0, 1) if r.random() < 0.9 else None, r.randrange(20_000), str(r.randrange(300))) for i in range(60_000)]
    df = spark.createDataFrame(rows, "part int, x double, k long, s string").repartition(6)
    parts = staged(K.profile(df, by=["part"]), str(tmp_path / "parts"))
    assert parts.count() == 7 * 3
    merged, whole = told(K.merge_profiles(parts)), told(K.profile(df, ["x", "k", "s"]))
    for c, i in (("x", 1), ("k", 2), ("s", 3)):
        values = [row[i] for row in rows if row[i] is not None]
        for got in (merged[c,], whole[c,]):
            assert (got.n_rows, got.n_present) == (60_000, len(values))
            assert abs(got.n_distinct / len(set(values)) - 1) < 0.04
            if c == "s":
                assert (got.low_text, got.high_text, got["mean"], got.quantiles) == (min(values), max(values), None, None)
                continue
            assert (got.low, got.high) == (min(values), max(values)) and math.isclose(got["mean"], sum(values) / len(values), abs_tol=1e-9)
            for p, q in zip((0.25, 0.5, 0.75), got.quantiles):
                assert abs(sum(v <= q for v in values) / len(values) - p) < 0.02


def test_new_rows_are_added_to_a_kept_profile(spark, tmp_path):
    kept = staged(K.profile(spark.range(100).selectExpr("id AS k")), str(tmp_path / "kept"))
    both = told(K.merge_profiles(kept, K.profile(spark.range(50, 150).selectExpr("id AS k"))))["k",]
    assert (both.n_rows, both.n_distinct, both.low, both.high) == (200, 150, 0, 149)


def test_edges(spark):
    df = spark.createDataFrame([(0.0, None, "é", True), (-0.0, None, "", False), (float("nan"), None, None, True)], "`a.b` double, n int, s string, f boolean")
    got = told(K.profile(df))
    assert (got["a.b",].n_present, got["a.b",].n_distinct) == (2, 1)
    assert (got["n",].n_present, got["n",].n_distinct, got["n",]["mean"], got["n",].quantiles) == (0, 0, None, None)
    assert (got["s",].n_distinct, got["s",].low_text) == (2, "") and (got["f",].n_distinct, got["f",].high) == (2, 1)
    empty = told(K.profile(df.limit(0)))
    assert all(r.n_rows == 0 and r.n_distinct == 0 for r in empty.values()) and len(empty) == 4
    assert K.profile(df.limit(0), ["n"], by=["s"]).count() == 0
    twice = told(K.merge_profiles(K.profile(df), K.profile(df.limit(0))))
    assert twice["n",].n_rows == 3 and twice["a.b",].n_distinct == 1
    mixed = K.merge_profiles(K.profile(df.select("n")), K.profile(df.select(F.col("n").cast("double"))))
    assert sorted(r["kind"] for r in mixed.collect()) == ["bigint", "double"]
    for call in (lambda: K.profile(df, []), lambda: K.profile(df.withColumnRenamed("n", "kind"), by=["kind"])):
        with pytest.raises(ValueError):
            call()


def test_one_shuffle_for_all_columns(spark):
    df = spark.range(10).selectExpr("id AS a", "id AS b", "string(id) AS c")
    text = K.profile(df)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Expand" not in text
