"""The trees of MLlib's boosting over few inputs, from rows counted by their bins.

That trainer sees a row by the bins of its inputs, its label and its weight. It
keeps every row as an object and goes over all of them for each level of each
tree. Over few inputs there are no more combinations of bins than ``CELLS``,
however many rows there are, so one aggregation counts the rows of each
combination (a cell), and the trees grow from the counts. Rows of a cell always
share their margin and their gradient; the bagging of a round draws how many of
a cell's rows take part, which for rows drawn one by one is binomial.

Split candidates, variance as impurity, the bound of rows at a leaf, the log
loss, the first tree's weight and the pseudo-residuals are those of MLlib, and
the result is its model.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import SparkContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.schema import quoted

# Combinations of bins that come to the driver at most, for each label in training and hold-out rows.
CELLS = 1 << 20
# Rows that propose the borders between bins, as many as MLlib's trainer draws for it.
PROPOSING_ROWS = 10_000
# Gains up to this share of the mean square are rounding.
ROUNDING = 1e-13


@dataclass
class CellNode:
    """A node of a tree: its sums over rows (weight, target, its square, rows) and, if it is split, where."""

    sums: tuple[float, float, float, int]
    gain: float = 0.0
    feature: int | None = None
    bin: int = 0
    left: CellNode | None = None
    right: CellNode | None = None


def _as_double(column: str) -> Column:
    return F.coalesce(F.col(quoted(column)).cast("double"), F.lit(float("nan")))


def _impurity(sums: np.ndarray) -> np.ndarray:
    """The variance from the last axis' weight, sum and sum of squares; 0 without weight."""
    weight = np.where(sums[..., 0] > 0, sums[..., 0], 1.0)
    return np.where(sums[..., 0] > 0, (sums[..., 2] - sums[..., 1] ** 2 / weight) / weight, 0.0)


def thresholds_of(values: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """The middles between values, all of them or those next to equal shares of the weight."""
    known = ~np.isnan(values)
    distinct, where = np.unique(values[known], return_inverse=True)
    sizes = np.bincount(where, weights[known], minlength=len(distinct))
    middles = (distinct[:-1] + distinct[1:]) / 2
    if len(middles) <= most:
        return middles
    stride, found = sizes.sum() / (most + 1), []
    target, upto = stride, np.cumsum(sizes)
    for i in range(1, len(distinct)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            found.append(middles[i - 1])
            target += stride
    return np.array(found)


def _bin(value: Column, thresholds: Sequence[float], low: int = 0) -> Column:
    """The number of thresholds below the value, by halves; all of them for NaN."""
    if not len(thresholds):
        return F.lit(low)
    half = len(thresholds) // 2
    return F.when(value <= F.lit(float(thresholds[half])), _bin(value, thresholds[:half], low)).otherwise(
        _bin(value, thresholds[half + 1 :], low + half + 1)
    )


def _grown(bins: np.ndarray, counts: Sequence[int], target: np.ndarray, weight: np.ndarray, drawn: np.ndarray, max_depth: int, min_rows: int):
    """A tree level by level, and its value for each cell."""
    weighted = drawn * weight
    parts = (weighted, weighted * target, weighted * target * target, drawn)
    root = CellNode(tuple(float(p.sum()) for p in parts))
    level, at, leaf = [root], np.zeros(len(target), np.int64), np.zeros(len(target))
    for depth in range(max_depth + 1):
        best: list[tuple[float, int, int, np.ndarray]] = [(0.0, -1, 0, np.zeros(4))] * len(level)
        if depth < max_depth:
            inside = np.flatnonzero(at >= 0)
            for f, n in enumerate(counts):
                place = at[inside] * n + bins[inside, f]
                hist = np.stack([np.bincount(place, p[inside], minlength=len(level) * n) for p in parts], axis=1).reshape(len(level), n, 4)
                left, all_ = np.cumsum(hist, axis=1)[:, :-1], hist.sum(axis=1, keepdims=True)
                right = all_ - left
                total = np.where(all_[..., 0] > 0, all_[..., 0], 1.0)
                gain = _impurity(all_) - left[..., 0] / total * _impurity(left) - right[..., 0] / total * _impurity(right)
                gain = np.where(np.minimum(left[..., 3], right[..., 3]) >= max(min_rows, 1), gain, 0.0)
                for i in range(len(level) if n > 1 else 0):
                    b = int(gain[i].argmax())
                    if gain[i, b] > best[i][0]:
                        best[i] = (float(gain[i, b]), f, b, left[i, b])
        following: list[CellNode] = []
        moved = np.full(len(target), -1)
        for i, node in enumerate(level):
            mine = np.flatnonzero(at == i)
            gain, f, b, low = best[i]
            # a node of one value has nothing to split; what rounding leaves of its variance is no gain
            if f < 0 or gain <= ROUNDING * node.sums[2] / node.sums[0]:
                leaf[mine] = node.sums[1] / node.sums[0] if node.sums[0] else 0.0
                continue
            node.gain, node.feature, node.bin = gain, f, b
            node.left, node.right = CellNode(tuple(low)), CellNode(tuple(np.array(node.sums) - low))
            moved[mine] = len(following) + (bins[mine, f] > b)
            following += [node.left, node.right]
        level, at = following, moved
        if not level:
            break
    return root, leaf


def _java_model(trainer: GBTClassifier, trees: Sequence[CellNode], weights: Sequence[float], thresholds: Sequence[np.ndarray]) -> GBTClassificationModel:
    """MLlib's model of the trees."""
    context = SparkContext._active_spark_context
    jvm, gateway = context._jvm, context._gateway
    ml = jvm.org.apache.spark.ml

    def node(n: CellNode):
        stats = gateway.new_array(jvm.double, 3)
        for i in range(3):
            stats[i] = float(n.sums[i])
        value, impurity = (n.sums[1] / n.sums[0] if n.sums[0] else 0.0), float(_impurity(np.array(n.sums)))
        held = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(stats, int(n.sums[3]))
        if n.left is None:
            return ml.tree.LeafNode(float(value), impurity, held)
        split = ml.tree.ContinuousSplit(n.feature, float(thresholds[n.feature][n.bin]))
        return ml.tree.InternalNode(float(value), impurity, float(n.gain), node(n.left), node(n.right), split, held)

    of_trees = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    of_weights = gateway.new_array(jvm.double, len(trees))
    for i, tree in enumerate(trees):
        of_trees[i], of_weights[i] = ml.regression.DecisionTreeRegressionModel(node(tree), len(thresholds)), float(weights[i])
    model = ml.classification.GBTClassificationModel(trainer.uid, of_trees, of_weights, len(thresholds), 2)
    trainer._transfer_params_to_java()
    trainer._java_obj.copyValues(model, trainer._java_obj.extractParamMap())
    return GBTClassificationModel(model)


def fits(df: DataFrame, features: Sequence[str], label: str, max_bins: int) -> bool:
    """Whether there are fewer cells than rows for sure; never where MLlib's trainer has an error: labels but 0 and 1, inputs that are missing or infinite."""
    if not features or max_bins ** len(features) > CELLS:
        return False
    sound = F.col(label).cast("double").isin(0.0, 1.0)
    for c in features:
        sound = sound & (F.abs(_as_double(c)) < F.lit(float("inf")))
    n, fine = df.filter(F.col(label).isNotNull()).agg(F.count(F.lit(1)), F.count_if(sound)).first()
    return n > CELLS and n == fine


def train_on_cells(
    df: DataFrame, features: Sequence[str], label: str, trainer: GBTClassifier, positive_weight: float, validation: str | None, first_rounds: int, patience: int
) -> GBTClassificationModel:
    """What ``scoring.train_boosted`` returns, for few inputs; ``df`` is read three times, whatever the number of rounds."""
    labelled = df.filter(F.col(label).isNotNull())
    held = F.coalesce(F.col(validation).cast("boolean"), F.lit(False)) if validation else F.lit(False)
    rows = labelled.select(held.alias("held"), (F.col(label) == 1).alias("one"), *[_as_double(c).alias(f"x{i}") for i, c in enumerate(features)])
    learned = rows.filter("NOT held")
    share = min(1.0, max(trainer.getMaxBins() ** 2, PROPOSING_ROWS) / max(learned.count(), 1))
    drawn = learned.sample(False, share, trainer.getSeed()).drop("held").toArrow()
    weights = np.where(drawn.column("one").to_numpy(), positive_weight, 1.0)
    thresholds = [thresholds_of(drawn.column(f"x{i}").to_numpy(), weights, trainer.getMaxBins() - 1) for i in range(len(features))]
    counts = [len(t) + 1 for t in thresholds]

    code = F.lit(0).cast("bigint")
    for i, t in enumerate(thresholds):
        code = code * F.lit(counts[i]) + _bin(F.col(f"x{i}"), t)
    cells = rows.groupBy((code * 4 + F.col("one").cast("int") * 2 + F.col("held").cast("int")).alias("code")).count().toArrow()
    codes, n = cells.column("code").to_numpy(), cells.column("count").to_numpy()
    order = np.argsort(codes)
    codes, n = codes[order], n[order]
    is_held, y = codes % 2 == 1, np.where(codes // 2 % 2 == 1, 1.0, -1.0)
    weight = np.where(y > 0, positive_weight, 1.0)
    if validation and not is_held.any():
        raise ValueError("the hold-out has no labelled row")
    bins, rest = np.empty((len(codes), len(features)), np.int16), codes // 4
    for i in reversed(range(len(features))):
        bins[:, i], rest = rest % counts[i], rest // counts[i]

    max_iter, step = trainer.getMaxIter(), trainer.getStepSize()
    rounds = min(first_rounds, max_iter) if validation else max_iter
    trees: list[CellNode] = []
    losses: list[float] = []
    margin = np.zeros(len(codes))
    while True:
        while len(trees) < rounds:
            some = np.random.default_rng([trainer.getSeed(), len(trees)]).binomial(n, trainer.getSubsamplingRate())
            target = 4 * y / (1 + np.exp(np.minimum(2 * y * margin, 700.0))) if trees else y
            tree, value = _grown(bins, counts, target, weight, np.where(is_held, 0, some).astype(float), trainer.getMaxDepth(), trainer.getMinInstancesPerNode())
            margin += (step if trees else 1.0) * value
            trees.append(tree)
            if validation:
                losses.append(float(np.average(2 * np.logaddexp(0, -2 * y[is_held] * margin[is_held]), weights=(n * weight)[is_held])))
        best = min(range(len(losses)), key=losses.__getitem__) + 1 if validation else rounds
        if not validation or rounds - best >= patience or rounds >= max_iter:
            break
        rounds = min(2 * rounds, max_iter)
    return _java_model(trainer, trees[:best], [1.0, *[step] * best][:best], thresholds)
