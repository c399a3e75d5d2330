"""Invariants of training, scoring, metrics and search."""

import random

import pytest
from pyspark.sql import functions as F

from entityloom.operators.ordering import top
from entityloom.plans import scoring as M
from entityloom.plans.search import SearchIncomplete, explore, explore_tables, propose, top_features

TREES = M.SEARCH_TREES.with_(max_iter=5, max_depth=3, min_instances=5)


@pytest.fixture(scope="module")
def separable(spark):
    df = spark.range(600).select(
        F.col("id"),
        F.pmod(F.xxhash64("id"), F.lit(100)).cast("double").alias("a"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)).cast("double").alias("b"),
        F.lit("x").alias("t"),
    )
    flagged = df.withColumn("y", F.when(F.col("a") + F.col("b") > 130, 1).otherwise(0))
    return flagged.withColumn("held", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(10)) == 0).cache()


def test_training_is_reproducible_and_sound(separable):
    inputs = ["a", "b"]
    first = M.train_boosted(separable, inputs, "y", TREES, "held")
    second = M.train_boosted(separable, inputs, "y", TREES, "held")
    scores = M.score(first, separable, inputs, "id")
    same = scores.join(M.score(second, separable, inputs, "id").withColumnRenamed("score", "other"), "id")
    assert same.filter("score <> other").count() == 0
    low, high = scores.agg(F.min("score"), F.max("score")).first()
    assert 0 <= low < high <= 1
    table = M.importance_table(first, inputs, separable)
    assert table.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    judged = scores.join(separable, "id")
    assert M.auc(judged, "score", "y").first()["auc"] > 0.9
    assert M.log_loss(judged, "score", "y").first()["logloss"] < 0.69


def test_the_first_rounds_are_a_model_without_another_fit(separable):
    whole = M.train_boosted(separable, ["a", "b"], "y", TREES)
    cut = M.first_rounds(whole, 2)
    assert whole.getNumTrees == 5 and cut.getNumTrees == 2 and M.first_rounds(whole, 9) is whole
    fitted = M.train_boosted(separable, ["a", "b"], "y", TREES.with_(max_iter=2))
    rows = M.score(cut, separable, ["a", "b"], "id").join(M.score(fitted, separable, ["a", "b"], "id").withColumnRenamed("score", "other"), "id")
    assert rows.filter("abs(score - other) > 1e-12").count() == 0 and rows.count() == 600


def test_search_by_gain_keeps_alike_candidates(separable):
    found = explore(separable.drop("held"), "id", "y", "t", target=3, top_n=3, per_round=30, params=TREES, judge="gain")
    assert len(found.specs) == 3 and found.table.count() == 600
    gains = {name: gain for _, name, _, gain, accepted in found.history if accepted}
    assert all(g > 0 for g in gains.values())
    with pytest.raises(ValueError):
        explore(separable, "id", "y", "t", judge="other")


def test_unlabelled_rows_do_not_train(separable):
    half = separable.withColumn("y", F.when(F.col("id") < 300, F.col("y")))
    model = M.train_boosted(half, ["a", "b"], "y", TREES)
    assert M.score(model, half, ["a", "b"], "id").count() == 600


@pytest.mark.parametrize("validation", ["held", None])
def test_a_task_of_the_trainer_has_a_bounded_number_of_rows(spark, separable, monkeypatch, validation):
    seen, fit = [], M.GBTClassifier.fit

    def watched(self, rows, *args):
        sizes = rows.groupBy(F.spark_partition_id()).count().collect()
        seen.append(([r["count"] for r in sizes], rows.select("label", "weight", "features").collect()))
        return fit(self, rows, *args)

    monkeypatch.setattr(M.GBTClassifier, "fit", watched)
    # many copies of some rows, few files
    copies = separable.filter("id < 5").withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(200)))).drop("i")
    rows = separable.unionByName(copies).coalesce(1)
    M.train_boosted(rows, ["a", "b"], "y", TREES, validation)
    few, whole = seen[-1]
    assert len(few) == 1
    monkeypatch.setattr(M, "TASK_BYTES", 50 * 240, raising=False)
    model = M.train_boosted(rows, ["a", "b"], "y", TREES, validation)
    many, dealt = seen[-1]
    assert sum(many) == sum(few) == len(whole) and max(many) <= 50
    key = lambda r: (r["label"], r["weight"], *r["features"])
    assert sorted(map(key, dealt)) == sorted(map(key, whole))
    assert M.auc(M.score(model, rows, ["a", "b"], "id", keep=["y"]), "score", "y").first()["auc"] > 0.9


def test_rows_counted_by_their_bins_train_as_rows_do(spark, separable, monkeypatch):
    # an input of one value; every row takes part in every round, so that both draw the same
    rows = separable.withColumn("c", F.lit(3.0))
    inputs, params = ["a", "b", "c"], TREES.with_(max_iter=12, first_rounds=4, patience=3, subsampling_rate=1.0)
    for validation in ("held", None):
        plain = M.train_boosted(rows, inputs, "y", params, validation)
        with monkeypatch.context() as patch:
            patch.setattr(M.cells, "CELLS", 32**3 - 1)
            assert not M.cells.fits(rows, inputs, "y", 32)
            patch.setattr(M.cells, "CELLS", 32**3)
            assert not M.cells.fits(rows, inputs, "y", 32)
            patch.setattr(M.cells, "fits", lambda *args: True)
            patch.setattr(M.GBTClassifier, "fit", None)
            counted = M.train_boosted(rows, inputs, "y", params, validation)
        assert counted.getNumTrees == plain.getNumTrees > 1 and counted.treeWeights == plain.treeWeights
        for a, b in zip(counted.trees, plain.trees):
            assert a.toDebugString.split("\n")[1:] and a.numNodes == b.numNodes and a.depth == b.depth
        assert counted.featureImportances.toArray() == pytest.approx(plain.featureImportances.toArray(), abs=1e-6)
        both = M.score(counted, rows, inputs, "id").join(M.score(plain, rows, inputs, "id").withColumnRenamed("score", "other"), "id")
        assert both.count() == 600 and both.filter("abs(score - other) > 1e-9").count() == 0


def test_many_rows_over_few_inputs_are_not_kept_one_by_one(spark, separable, monkeypatch):
    monkeypatch.setattr(M.cells, "CELLS", 33 * 32)
    many = separable.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(3)))).drop("i")
    fitted = []
    monkeypatch.setattr(M.GBTClassifier, "fit", lambda *args: fitted.append(args))
    model = M.train_boosted(many, ["a", "b"], "y", TREES, "held")
    assert not fitted and model.getNumTrees > 1
    scores = M.score(model, separable, ["a", "b"], "id", keep=["y"])
    assert scores.count() == 600 and M.auc(scores, "score", "y").first()["auc"] > 0.9
    again = M.score(M.train_boosted(many.repartition(3), ["a", "b"], "y", TREES, "held"), separable, ["a", "b"], "id").withColumnRenamed("score", "other")
    assert again.count() == 600
    with pytest.raises(ValueError):
        M.train_boosted(many.withColumn("held", F.lit(False)), ["a", "b"], "y", TREES, "held")
    assert M.cells.fits(many, ["a", "b"], "y", 32) and not M.cells.fits(many.withColumn("y", F.col("id") % 3), ["a", "b"], "y", 32)
    for odd in (None, float("nan"), float("-inf")):
        assert not M.cells.fits(many.withColumn("a", F.when(F.col("id") == 7, F.lit(odd)).otherwise(F.col("a"))), ["a", "b"], "y", 32)
    assert M.cells.fits(many.withColumn("a", F.when(F.col("id") != 7, F.col("a"))).withColumn("y", F.when(F.col("id") != 7, F.col("y"))), ["a", "b"], "y", 32)


def test_thresholds_are_next_to_equal_shares():
    import numpy as np

    few = M.cells.thresholds_of(np.array([1.0, 3.0, 2.0, np.nan, 3.0]), np.ones(5), 31)
    assert few.tolist() == [1.5, 2.5]
    many = M.cells.thresholds_of(np.arange(100.0), np.ones(100), 3)
    assert many.tolist() == [24.5, 49.5, 74.5]
    assert M.cells.thresholds_of(np.array([np.nan]), np.ones(1), 3).tolist() == []


def test_auc_counts_pairs(spark):
    rng = random.Random(2)
    data = [(rng.randrange(10) / 10, rng.randrange(2)) for _ in range(200)] + [(0.5, None)]
    df = spark.createDataFrame(data, "p double, y int")
    wins = pairs = 0.0
    for p, y in data:
        for q, z in data:
            if y == 1 and z == 0:
                pairs += 1
                wins += 1.0 if p > q else 0.5 if p == q else 0.0
    assert M.auc(df, "p", "y").first()["auc"] == pytest.approx(wins / pairs)
    one_class = M.auc(df.filter("y = 1"), "p", "y").first()
    assert one_class["auc"] is None and one_class["negatives"] == 0


def test_metrics(spark):
    df = spark.createDataFrame([(0.9, 1), (0.2, 1), (0.1, 0), (1.0, 0), (0.7, None)], "p double, y int")
    counts = {(r["label"], r["prediction"]): r["n_rows"] for r in M.confusion(df, "p", "y").collect()}
    assert counts == {(1, 1): 1, (1, 0): 1, (0, 0): 1, (0, 1): 1}
    assert M.accuracy(df, "p", "y").first()[0] == 0.5
    # a certain and wrong score costs a finite amount
    assert 0 < M.log_loss(df, "p", "y").first()[0] < 20


def test_proposals_are_seeded_and_new():
    seen = set()
    a = propose(["x", "y", "z"], 5, random.Random(1), "c", "t", seen)
    b = propose(["x", "y", "z"], 100, random.Random(1), "c", "t", seen)
    assert a == propose(["x", "y", "z"], 5, random.Random(1), "c", "t")
    assert len(seen) == len(a) + len(b) == 3 * 2 * 5
    assert all(len(set(s.features)) == 2 for s in a + b)
    with pytest.raises(ValueError):
        propose(["x"], 1, random.Random(1), "c", "t")


def test_top_features_ranks_used_ones():
    assert top_features({"b": 0.3, "a": 0.3, "c": 0.4, "d": 0.0}, 3) == ["c", "a", "b"]
    assert top_features({"a": 0.0}, 3) == []


def test_search_finds_a_pair_feature(separable):
    found = explore(
        separable.drop("held"), "id", "y", "df", target=2, top_n=4, per_round=8, params=TREES, seed=4
    )
    assert len(found.specs) == 2
    assert [s.name for s in found.specs] == [f"f_{i}_df" for i in range(len(found.specs))]
    assert found.table.columns == ["id", "a", "b", "t", "y", *[s.name for s in found.specs]]
    assert found.table.count() == 600
    accepted = [h for h in found.history if h[4]]
    assert [h[1] for h in accepted] == [s.name for s in found.specs]


def test_search_over_tables(spark, separable):
    child = separable.select("id", (F.col("a") * 2).alias("a"), F.col("b").alias("w")).filter("id % 2 = 0")
    base = separable.select("id", "a", "y")
    found = explore_tables(
        base, {"child": child}, "id", "y", target=1, top_n=5, per_round=2, params=TREES
    )
    assert list(found) == ["child"]
    assert found["child"].table.columns[:5] == ["id", "a", "y", "a_child", "w"]
    assert found["child"].table.count() == 600


def test_importance_gate(separable):
    model = M.train_boosted(separable, ["a", "b"], "y", TREES)
    table = M.importance_table(model, ["a", "b"], separable)
    assert {r["column"] for r in top(table, "importance", 2, ["column"]).collect()} == {"a", "b"}


def test_principal_components(spark):
    df = spark.range(50).selectExpr("id", "double(id) AS a", "double(id) * 2 AS b")
    out = M.principal_components(df, ["a", "b"], 2, ["id"])
    assert out.columns == ["id", "pc_1", "pc_2"]
    # the columns are proportional: one component holds everything
    assert out.agg(F.stddev("pc_2")).first()[0] == pytest.approx(0, abs=1e-9)


def test_an_ended_search_raises_with_what_it_has(separable):
    with pytest.raises(SearchIncomplete, match="1 rounds are over") as error:
        explore(separable.drop("held"), "id", "y", "df", target=50, top_n=4, per_round=3, max_rounds=1, params=TREES)
    assert len(error.value.result.specs) < 50 and error.value.result.table.count() == 600
    with pytest.raises(SearchIncomplete, match="all combinations"):
        explore(separable.select("id", "a", "b", "y"), "id", "y", "df", target=11, top_n=0, per_round=10, params=TREES.with_(max_iter=1))


def test_boosting_goes_on_until_the_hold_out_tells(separable):
    params = M.SEARCH_TREES.with_(max_depth=3, min_instances=5, first_rounds=4, patience=4, max_iter=64, positive_weight=1.0)
    model = M.train_boosted(separable, ["a", "b"], "y", params, "held")
    assert 1 < model.getNumTrees <= 64
    losses = M.train_boosted(separable.filter("NOT held"), ["a", "b"], "y", params.with_(max_iter=model.getNumTrees + 2)).evaluateEachIteration(
        M.assemble_vector(separable.filter("held"), ["a", "b"], [F.col("y").cast("double").alias("label"), F.lit(1.0).alias("weight")])
    )
    assert losses[model.getNumTrees - 1] <= min(losses) + 0.02
    for preset in (M.LARGE_TREES, M.SMALL_TREES, M.SEARCH_TREES, M.ORDERED_TREES):
        assert preset.max_iter >= 5000 and preset.patience >= 50
    # a missing flag trains
    some = separable.withColumn("held", F.when(F.col("id") < 100, F.col("held")))
    assert M.train_boosted(some, ["a", "b"], "y", TREES, "held").getNumTrees >= 1
    with pytest.raises(ValueError):
        M.train_boosted(separable.withColumn("held", F.lit(False)), ["a", "b"], "y", TREES, "held")


def test_principal_components_refuse_missing_cells(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 3.0)], "id long, a double, b double")
    with pytest.raises(Exception, match="(?i)null|NaN"):
        M.principal_components(df, ["a", "b"], 1, ["id"]).collect()
