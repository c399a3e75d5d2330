"""Sparse indicators of columns with any number of values."""

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from entityloom.operators import encode, rollup, sparse


def test_shares_agree_with_the_long_form(spark):
    rows = [(1, "a", "x"), (1, "a", None), (1, "b", "x"), (2, None, "é"), (2, "", "x"), (None, "z", "y"), (3, "new", "x")]
    df = spark.createDataFrame(rows, "k int, p string, `q.r` string").repartition(3)
    slots = sparse.fit_slots(df.filter("p IS NULL OR p <> 'new'"), columns=["p", "q.r"])
    names = {r["slot"]: (r["column"], r["value"]) for r in slots.table.collect()}
    assert sorted(names) == list(range(slots.size)) and [names[i] for i in range(slots.size)] == sorted(names.values())
    got = {(r["k"], *names[i]): s for r in sparse.sparse_shares(df, "k", slots).collect() for i, s in zip(r["indices"], r["shares"])}
    long = rollup.category_share_long(df, "k", ["p", "q.r"]).collect()
    assert got == {(r["k"], r["column"], r["value"]): r["share"] for r in long if r["value"] != "new"}
    assert {r["k"]: r["n_rows"] for r in sparse.sparse_shares(df, "k", slots).collect()} == {1: 3, 2: 2, 3: 1}
    # an entity of which no value was seen keeps its rows
    other = spark.createDataFrame([(5, "?", "?")], df.schema)
    assert tuple(sparse.sparse_shares(other, "k", slots).first()) == (5, 1, [], [])


@pytest.mark.parametrize("broadcast", [True, False])
def test_rows_agree_with_one_hot(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(sparse, "BROADCAST_BYTES", 0)
    df = spark.createDataFrame([(1, "a", "x"), (2, None, "x"), (3, "b", None), (3, "b", None)], "id int, p string, q string")
    slots = sparse.fit_slots(df, columns=["p", "q"])
    wide = encode.one_hot(df.na.fill(""), {"p": ["", "a", "b"], "q": ["", "x"]})
    flags = [c for c in wide.columns if c.startswith("feature_") and not c.endswith("_nan")]
    want = sorted((r["id"], *[float(r[c]) for c in flags]) for r in wide.collect())
    vectors = sparse.as_vectors(sparse.sparse_rows(df, slots), slots)
    got = sorted((r["id"], *r["v"]) for r in vectors.select("id", vector_to_array("features").alias("v")).collect())
    assert slots.size == len(flags) == 5 and got == want


def test_a_hundred_thousand_values_through_rollup_and_fit(spark):
    rows = spark.range(200_000).selectExpr("id % 2000 AS k", "concat('v', id % 100000) AS p", "CASE WHEN id % 2000 < 700 THEN 'bad' ELSE 'good' END AS q")
    slots = sparse.fit_slots(rows, columns=["p", "q"])
    assert slots.size == 100_002
    vectors = sparse.as_vectors(sparse.sparse_shares(rows, "k", slots), slots).withColumn("label", (F.col("k") < 700).cast("double"))
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    first = vectors.filter("k = 5").first()
    assert first["n_rows"] == 100 and first["features"].size == 100_002 and first["features"].numNonzeros() == 51
    assert abs(sum(first["features"].values) - 2) < 1e-9
    model = LogisticRegression(maxIter=5).fit(vectors)
    assert model.transform(vectors).filter("prediction <> label").count() == 0


def test_edges(spark):
    df = spark.createDataFrame([], "k int, p string")
    slots = sparse.fit_slots(df, columns=["p"])
    assert slots.size == 0 and sparse.sparse_shares(df, "k", slots).count() == 0 and sparse.sparse_rows(df, slots).count() == 0
    assert sparse.as_vectors(sparse.sparse_rows(df, slots), slots).count() == 0
    for call in (
        lambda: sparse.fit_slots(df, columns=[]),
        lambda: sparse.sparse_shares(df, "p", slots),
        lambda: sparse.sparse_rows(df.withColumn("indices", F.lit(1)), slots),
        lambda: sparse.as_vectors(sparse.sparse_rows(df, slots), slots, "k"),
    ):
        with pytest.raises(ValueError):
            call()
