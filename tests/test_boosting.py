"""Leaf-wise trees, AUC per round, importances and screening against plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from entityloom.plans import boosting as B
from entityloom.plans import scoring as M

PARAMS = B.LeafParams(num_leaves=7, step_size=0.3, max_rounds=3, min_rows=5, max_bins=16, block=2)


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(5)
    data = []
    for i in range(900):
        a, b, c = r.randrange(30), r.random() * 10, r.choice([None, 1.0, 2.0, 3.0])
        chance = 1 / (1 + math.exp(-(0.2 * (a - 15) + (b - 5) * (1 if a > 10 else -1) + (1.5 if c is None else 0))))
        data.append((i, float(a), b, c, r.random(), int(r.random() < chance), i % 5 == 0))
    data += [(1000, 3.0, None, float("nan"), 0.5, None, None), (1001, None, None, None, None, None, True)]
    return spark.createDataFrame(data, "id long, a double, b double, c double, noise double, y int, held boolean").repartition(4).cache()


INPUTS = ["a", "b", "c", "noise"]


def _plain_tree(bins, g, h, p):
    """One leaf at a time, in numpy."""

    def best(mask):
        found = None
        G, H, n = g[mask].sum(), h[mask].sum(), mask.sum()
        for f in range(bins.shape[1]):
            for b in range(0, bins[:, f].max() + 1):
                for missing_left in (False, True):
                    if missing_left and not (bins[mask, f] == 0).any() or b == 0 and not missing_left:
                        continue
                    left = mask & ((bins[:, f] >= 1) & (bins[:, f] <= b) | (missing_left & (bins[:, f] == 0)))
                    m = left.sum()
                    if not b in bins[mask, f] or min(m, n - m) < max(1, p.min_rows):
                        continue
                    gl, hl = g[left].sum(), h[left].sum()
                    if min(hl, H - hl) < p.min_hessian:
                        continue
                    gain = gl**2 / hl + (G - gl) ** 2 / (H - hl) - G**2 / H
                    if gain <= 0:
                        continue
                    key = (-float(f"{gain:.8e}"), f, b, missing_left)
                    if found is None or key < found[0]:
                        found = key, left
        return found

    leaves, splits, made = {0: np.ones(len(g), bool)}, [], 1
    known = {0: best(leaves[0])}
    while len(leaves) < p.num_leaves:
        open_ = [i for i in leaves if known[i]]
        if not open_:
            break
        i = min(open_, key=lambda i: (known[i][0][0], i))
        (gain, f, b, missing_left), left = known[i]
        mask = leaves.pop(i)
        splits.append((f, b, missing_left))
        leaves[made], leaves[made + 1] = mask & left, mask & ~left
        known[made], known[made + 1] = best(leaves[made]), best(leaves[made + 1])
        made += 2
    return splits, sorted((-p.step_size * g[m].sum() / h[m].sum(), int(m.sum())) for m in leaves.values())


def test_trees_are_those_of_plain_best_first_growth(rows):
    model = B.train_leafwise(rows, INPUTS, "y", PARAMS, "held")
    learned = B.binned(rows.filter("y IS NOT NULL AND NOT held"), INPUTS, model.borders, [F.col("y")]).collect()
    bins, y = np.array([r.bins for r in learned]), np.array([r.y for r in learned], float)
    margin = np.full(len(y), math.log(y.mean() / (1 - y.mean())))
    assert model.base == pytest.approx(margin[0])
    for tree in model.trees:
        p = 1 / (1 + np.exp(-margin))
        splits, leaves = _plain_tree(bins, p - y, p * (1 - p), PARAMS)
        inner = [n for n in tree.values() if n.left is not None]
        assert [(n.feature, n.bin, n.missing_left) for n in sorted(inner, key=lambda n: n.left)] == splits
        mine = sorted((n.value, n.rows) for n in tree.values() if n.left is None)
        assert len(mine) <= PARAMS.num_leaves and [m[1] for m in mine] == [x[1] for x in leaves]
        assert [m[0] for m in mine] == pytest.approx([x[0] for x in leaves])
        for i, b in enumerate(bins):
            at = tree[0]
            while at.left is not None:
                left = at.missing_left if b[at.feature] == 0 else b[at.feature] <= at.bin
                at = tree[at.left if left else at.right]
            margin[i] += at.value


def test_auc_of_every_round_and_the_best_prefix(rows):
    params = PARAMS.with_(max_rounds=24, patience=3, block=4, step_size=0.8, num_leaves=5)
    model = B.train_leafwise(rows, INPUTS, "y", params, "held")
    held = rows.filter("held")
    assert len(model.trees) == max(range(len(model.auc_per_round)), key=model.auc_per_round.__getitem__) + 1
    assert len(model.auc_per_round) < 24  # it stopped by itself
    for rounds in (1, len(model.trees)):
        scored = held.withColumn("s", model.margin(rounds))
        assert M.auc(scored, "s", "y").first()["auc"] == pytest.approx(model.auc_per_round[rounds - 1], abs=1e-12)
    filled = rows.fillna(-1.0, INPUTS)
    plain = M.train_boosted(filled, INPUTS, "y", M.SEARCH_TREES.with_(max_iter=20, first_rounds=20, max_depth=3, min_instances=5, positive_weight=1.0), "held")
    other = M.auc(M.score(plain, filled.filter("held"), INPUTS, "id", keep=["y"]), "score", "y").first()["auc"]
    assert model.auc_per_round[len(model.trees) - 1] >= other - 0.02
    scores = B.score_leafwise(model, rows, "id", keep=["y"])
    assert scores.count() == rows.count() and scores.filter("score IS NULL OR score <= 0 OR score >= 1").count() == 0


def test_bounds_of_the_driver_change_nothing(rows, monkeypatch):
    whole = B.train_leafwise(rows, INPUTS, "y", PARAMS.with_(max_rounds=1))
    monkeypatch.setattr(B, "PASS_CELLS", 1)
    monkeypatch.setattr(B, "HELD_CELLS", 1)
    small = B.train_leafwise(rows, INPUTS, "y", PARAMS.with_(max_rounds=1))
    told = lambda m: [(n.feature, n.bin, n.missing_left, n.rows, round(n.value, 9)) for n in m.trees[0].values()]
    assert told(whole) == told(small)


def test_bagging_draws_and_repeats(rows):
    params = PARAMS.with_(bagging_fraction=0.5, bagging_freq=2, max_rounds=3)
    one, two = (B.train_leafwise(rows, INPUTS, "y", params) for _ in range(2))
    drawn = [t[0].rows for t in one.trees]
    assert drawn == [t[0].rows for t in two.trees] and drawn[0] == drawn[1] != drawn[2]
    assert all(0.4 < n / 900 < 0.6 for n in drawn)


def test_importances_from_the_tree_table(spark, rows):
    model = B.train_leafwise(rows, INPUTS, "y", PARAMS)
    table = model.table(spark)
    split, gain, change = {}, {}, {}
    for tree in model.trees:
        def value(n):
            if n.left is None:
                return n.value, n.rows
            (a, x), (b, y) = value(tree[n.left]), value(tree[n.right])
            return (a * x + b * y) / (x + y), x + y

        for n in tree.values():
            if n.left is not None:
                c = INPUTS[n.feature]
                (a, x), (b, y) = value(tree[n.left]), value(tree[n.right])
                m = (a * x + b * y) / (x + y)
                split[c] = split.get(c, 0) + 1
                gain[c] = gain.get(c, 0) + n.gain
                change[c] = change.get(c, 0) + (a - m) ** 2 * x + (b - m) ** 2 * y
    total = sum(change.values())
    for kind, want in (("split", split), ("gain", gain), ("change", {c: 100 * v / total for c, v in change.items()})):
        assert {r["column"]: r["importance"] for r in B.importances(table, kind).collect()} == pytest.approx(want)
    with pytest.raises(ValueError):
        B.importances(table, "other")


def test_screening_ranks_as_single_fits(rows):
    tried = rows.withColumn("copy", F.col("a")).withColumn("flat", F.lit(1.0)).withColumn("none", F.lit(None).cast("double"))
    names = [*INPUTS, "copy", "flat", "none"]
    found = {r["column"]: r["gain"] for r in B.screened(tried, names, "y", params=PARAMS).collect()}
    assert found["copy"] == found["a"] > 0 and found["flat"] == found["none"] == 0
    stump = PARAMS.with_(num_leaves=2, max_rounds=1)
    for c in INPUTS:
        alone = B.train_leafwise(tried, [c], "y", stump).trees[0]
        assert found[c] == pytest.approx(alone[0].gain, rel=1e-8)
    model = B.train_leafwise(tried, ["a"], "y", PARAMS.with_(max_rounds=6))
    left = {r["column"]: r["gain"] for r in B.screened(tried, names, "y", model.margin(), PARAMS).collect()}
    assert left["a"] < 0.3 * found["a"] and left["b"] > left["a"]


def test_one_label_or_no_rows_are_errors(rows):
    for part in (rows.filter("y = 1"), rows.limit(0), rows.filter("y IS NULL")):
        with pytest.raises(ValueError):
            B.train_leafwise(part, INPUTS, "y", PARAMS)
    with pytest.raises(ValueError):
        B.train_leafwise(rows, INPUTS, "y", PARAMS.with_(max_rounds=1), "y")
