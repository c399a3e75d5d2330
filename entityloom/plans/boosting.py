"""Boosted trees that grow leaf by leaf, from histograms merged by one aggregation.

**Bins.** Every input is cut at borders into at most ``max_bins`` bins, missing
values into one of their own (0). The rows are stored once, as an array of bins
with label, weight and margin; nothing else of them is read again, and no row
leaves the executors.

**Histograms.** For a set of tree nodes, one aggregation sums gradients, second
derivatives and rows by (node, input, bin). Partial sums are made before the
exchange, so its rows are bounded by nodes, inputs and bins, and it is these
cells that come to the driver, at most ``PASS_CELLS`` at a time. Only the smaller
of two siblings is counted; the other one's histogram is that of the parent less
the sibling's. At most ``HELD_CELLS`` are held for that; where a parent's are not,
both children are counted.

**Best first.** The leaf with the largest gain is split next, until the tree has
``num_leaves`` leaves. A pass expands all leaves that could still be split within
that budget, some of them in vain, so the number of passes follows the depth of
the tree and not its leaves. What was expanded in vain is left out: the tree is
the one that splitting one leaf at a time gives.

**Stopping.** Rounds are grown in blocks. Behind a block, the hold-out's scores
after each of its rounds are judged together by ``auc_by_round``, one aggregation
and one range sort for all of them. Growing goes on from the stored margins, no
tree is fitted twice, and the model keeps the rounds up to the best one.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from entityloom.operators.ordering import running_sums
from entityloom.schema import quoted
from entityloom.session import stored

MISSING_BIN = 0


@dataclass(frozen=True)
class LeafParams:
    """What the trainer is told. Rows of label 1 weigh ``positive_weight``.

    Every ``bagging_freq`` rounds another ``bagging_fraction`` of the rows is drawn
    by hash; 0 turns it off. ``block`` rounds are grown between two looks at the
    hold-out, and ``patience`` rounds without a better AUC end the training.
    """

    num_leaves: int = 31
    step_size: float = 0.1
    max_rounds: int = 10_000
    patience: int = 50
    min_rows: int = 100
    min_hessian: float = 1e-3
    reg_lambda: float = 0.0
    positive_weight: float = 1.0
    max_bins: int = 64
    bagging_fraction: float = 1.0
    bagging_freq: int = 0
    block: int = 5
    seed: int = 42

    def with_(self, **changes) -> LeafParams:
        return replace(self, **changes)


# Leaves, learning rate, rounds, patience, leaf size, bagging and weight in use.
LARGE_LEAVES = LeafParams(1023, 0.01, 5_000, 100, 50, bagging_fraction=0.8, bagging_freq=2)
SMALL_LEAVES = LeafParams(31, 0.01, 10_000, 100, 100, bagging_fraction=0.8, bagging_freq=2, positive_weight=12.0)
SEARCH_LEAVES = LeafParams(31, 0.1, 10_000, 50, 100, bagging_fraction=0.8, bagging_freq=2, positive_weight=12.0)


@dataclass
class Node:
    """A node of a tree; ``feature`` is missing in leaves. Rows with a bin up to ``bin`` go left."""

    id: int
    gradient: float
    hessian: float
    rows: int
    gain: float = 0.0
    feature: int | None = None
    bin: int = 0
    missing_left: bool = False
    left: int | None = None
    right: int | None = None
    value: float = 0.0
    low: tuple[float, float, int] = (0.0, 0.0, 0)  # the sums of its left side


@dataclass
class LeafModel:
    """Trees over ``features`` with the borders of their bins; scores are logistic."""

    features: list[str]
    borders: dict[str, list[float]]
    base: float
    trees: list[dict[int, Node]] = field(default_factory=list)
    auc_per_round: list[float] = field(default_factory=list)

    def margin(self, rounds: int | None = None) -> Column:
        """The sum of the trees over the inputs' columns."""
        total = F.lit(self.base)
        for tree in self.trees[:rounds]:
            total = total + self._walk(tree, 0)
        return total

    def _threshold(self, node: Node) -> float:
        """The largest value that goes left: none for bin 0, any for the last bin (only missing values go right)."""
        borders = self.borders[self.features[node.feature]]
        return -math.inf if node.bin == MISSING_BIN else borders[node.bin - 1] if node.bin <= len(borders) else math.inf

    def _walk(self, tree: dict[int, Node], at: int) -> Column:
        node = tree[at]
        if node.left is None:
            return F.lit(node.value)
        c = number(self.features[node.feature])
        goes_left = F.when(c.isNull(), F.lit(node.missing_left)).otherwise(c <= F.lit(self._threshold(node)))
        return F.when(goes_left, self._walk(tree, node.left)).otherwise(self._walk(tree, node.right))

    def table(self, spark: SparkSession) -> DataFrame:
        """The trees as rows ``tree, node, left, right, column, threshold, missing_left, gain, rows, value``.

        ``value`` is what a leaf adds to the margin; of an inner node it is the
        average of its leaves by their rows.
        """
        out = []
        for number_, tree in enumerate(self.trees):
            values = subtree_values(tree)
            for n in tree.values():
                inner = n.left is not None
                column = self.features[n.feature] if inner else None
                threshold = self._threshold(n) if inner else None
                out.append((number_, n.id, n.left, n.right, column, threshold, n.missing_left if inner else None, n.gain if inner else None, n.rows, values[n.id]))
        return spark.createDataFrame(
            out,
            "tree int, node int, left int, right int, column string, threshold double, missing_left boolean, gain double, rows bigint, value double",
        )


def number(column: str) -> Column:
    """An input as a double; NaN is missing."""
    c = F.col(quoted(column)).cast("double")
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def subtree_values(tree: Mapping[int, Node]) -> dict[int, float]:
    """The leaf values, and for inner nodes their average by rows."""
    values: dict[int, float] = {}
    for n in sorted(tree.values(), key=lambda n: -n.id):  # children have larger ids
        if n.left is None:
            values[n.id] = n.value
        else:
            a, b = tree[n.left], tree[n.right]
            values[n.id] = (values[a.id] * a.rows + values[b.id] * b.rows) / max(a.rows + b.rows, 1)
    return values


def find_borders(df: DataFrame, features: Sequence[str], max_bins: int = 64, accuracy: int = 10_000) -> dict[str, list[float]]:
    """Borders between bins at quantiles of the values present, for all inputs in one aggregation."""
    shares = [i / max_bins for i in range(1, max_bins)]
    finite = lambda c: F.when(F.abs(number(c)) < float("inf"), number(c))
    row = df.agg(*[F.percentile_approx(finite(c), F.array(*[F.lit(s) for s in shares]), F.lit(accuracy)).alias(f"q{i}") for i, c in enumerate(features)]).first()
    return {c: sorted(set(row[f"q{i}"] or [])) for i, c in enumerate(features)}


def binned(df: DataFrame, features: Sequence[str], borders: Mapping[str, Sequence[float]], keep: Sequence[Column]) -> DataFrame:
    """The ``keep`` columns and ``bins array<smallint>``: borders below the value, plus 1; a missing value has bin 0.

    The borders are one constant array, so the plan does not grow with the bins.
    """
    every = F.array(*[F.array(*[F.lit(float(b)) for b in borders[c]]).cast("array<double>") for c in features])
    below = lambda value, i: F.size(F.filter(F.get(every, i), lambda b: b < value))
    values = F.array(*[number(c) for c in features])
    bins = F.transform(values, lambda v, i: F.when(v.isNull(), F.lit(MISSING_BIN)).otherwise(below(v, i) + 1).cast("smallint"))
    return df.select(*keep, bins.alias("bins"))


def histograms(rows: DataFrame) -> DataFrame:
    """``node, f, b, g, h, n``: sums by node, input and bin of rows ``node, bins, g, h``."""
    cells = rows.select("node", "g", "h", F.posexplode("bins").alias("f", "b"))
    return cells.groupBy("node", "f", "b").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count(F.lit(1)).alias("n"))


def split_gains(hists: DataFrame, min_rows: int = 1, min_hessian: float = 0.0, reg_lambda: float = 0.0) -> DataFrame:
    """Every split of every node: ``node, f, b, missing_left``, the sums of its left side, of the node, and ``gain``.

    Rows with a bin up to ``b`` go left, and rows of bin 0 to the side that
    ``missing_left`` tells; where no value is missing only right is offered. The
    gain is rounded to nine digits, so that the order of addition decides nothing.
    """
    side = Window.partitionBy("node", "f")
    upto = side.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    present = F.col("b") > MISSING_BIN
    columns = []
    for c in ("g", "h", "n"):
        columns += [
            F.sum(c).over(side).alias(f"all_{c}"),
            F.coalesce(F.sum(F.when(present, F.col(c))).over(upto), F.lit(0)).alias(f"low_{c}"),
            F.coalesce(F.sum(F.when(~present, F.col(c))).over(side), F.lit(0)).alias(f"none_{c}"),
        ]
    sums = hists.select("node", "f", "b", *columns)
    ways = F.when(F.col("none_n") > 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    split = sums.withColumn("missing_left", F.explode(ways))
    left = {c: F.col(f"low_{c}") + F.when(F.col("missing_left"), F.col(f"none_{c}")).otherwise(F.lit(0)) for c in ("g", "h", "n")}
    split = split.select("node", "f", "b", "missing_left", *[v.alias(f"left_{c}") for c, v in left.items()], "all_g", "all_h", "all_n")
    # bin 0 alone on the left is the split by missing values
    split = split.filter("(b > 0 OR missing_left) AND left_n < all_n AND left_n > 0")
    split = split.filter((F.col("left_n") >= min_rows) & (F.col("all_n") - F.col("left_n") >= min_rows))
    split = split.filter((F.col("left_h") >= min_hessian) & (F.col("all_h") - F.col("left_h") >= min_hessian))
    term = lambda g, h: F.try_divide(g * g, h + F.lit(reg_lambda))
    gain = term(F.col("left_g"), F.col("left_h")) + term(F.col("all_g") - F.col("left_g"), F.col("all_h") - F.col("left_h")) - term(F.col("all_g"), F.col("all_h"))
    digits = F.lit(9) - F.ceil(F.log10(F.greatest(F.abs(gain), F.lit(1e-300))))
    return split.withColumn("gain", F.round(gain * F.pow(F.lit(10.0), digits)) / F.pow(F.lit(10.0), digits))


# Cells (node, input, bin) that one aggregation brings to the driver, and that are held there for the rest of a tree (200 MB).
PASS_CELLS, HELD_CELLS = 1_000_000, 8_000_000


def _fetched(rows: DataFrame, nodes: Sequence[int], shape: tuple[int, int]) -> dict[int, np.ndarray]:
    """The histograms of the nodes as arrays (input, bin, sum); the cells that come depend on the plan, not on the rows."""
    found = {i: np.zeros((*shape, 3)) for i in nodes}
    step = max(1, PASS_CELLS // (shape[0] * shape[1]))
    for start in range(0, len(nodes), step):
        part = list(nodes[start : start + step])
        cells = histograms(rows.filter(F.col("node").isin(part))).toArrow()
        node, f, b = (cells.column(c).to_numpy() for c in ("node", "f", "b"))
        sums = np.stack([cells.column(c).to_numpy().astype(float) for c in "ghn"], axis=1)
        for i in part:
            mine = node == i
            found[i][f[mine], b[mine]] = sums[mine]
    return found


def _note_split(node: Node, hist: np.ndarray, params: LeafParams) -> None:
    """Give the node its best split: the first input, the lowest bin and missing to the right decide among equals."""
    none, low = hist[:, :1], np.cumsum(hist[:, 1:], axis=1)
    low = np.concatenate([np.zeros_like(none), low], axis=1)
    left = np.stack([low, low + none], axis=2)  # input, bin, missing right or left, sum
    all_ = hist.sum(axis=1)[:, None, None, :]
    right = all_ - left
    fits = (np.minimum(left[..., 2], right[..., 2]) >= max(1, params.min_rows)) & (np.minimum(left[..., 1], right[..., 1]) >= params.min_hessian)
    fits[..., 1] &= none[..., 2] > 0
    with np.errstate(divide="ignore", invalid="ignore"):
        term = lambda x: x[..., 0] ** 2 / (x[..., 1] + params.reg_lambda)
        gain = np.where(fits, term(left) + term(right) - term(all_), 0.0)
    gain = np.where(np.isfinite(gain), gain, 0.0)
    best = gain.max(initial=0.0)
    if best <= 0:
        return
    # equal up to nine digits, so that the order of addition decides nothing
    f, b, missing_left = (int(x) for x in np.argwhere(gain >= best * (1 - 1e-9))[0])
    node.gain, node.feature, node.bin, node.missing_left = float(best), f, b, bool(missing_left)
    g, h, n = left[f, b, missing_left]
    node.low = (float(g), float(h), int(n))


def _assigned(tree: Mapping[int, Node], bins: Column, at: int = 0) -> Column:
    """The number of the node a row reaches."""
    node = tree[at]
    if node.left is None:
        return F.lit(at)
    b = bins[node.feature]
    left = b.between(1, node.bin)
    if node.missing_left:
        left = left | (b == MISSING_BIN)
    return F.when(left, _assigned(tree, bins, node.left)).otherwise(_assigned(tree, bins, node.right))


def _best_first(tree: Mapping[int, Node], num_leaves: int) -> tuple[list[int], list[int]]:
    """The nodes that best-first growth splits as far as is known, and the leaves it may want to split next."""
    frontier, split, leaves = [0], [], 1
    while leaves < num_leaves:
        open_ = [i for i in frontier if tree[i].gain > 0]
        if not open_:
            return split, []
        i = min(open_, key=lambda i: (-tree[i].gain, i))
        if tree[i].left is None:  # its children are not known yet
            unknown = sorted((x for x in open_ if tree[x].left is None), key=lambda x: (-tree[x].gain, x))
            return split, unknown[: num_leaves - leaves]
        frontier.remove(i)
        frontier += [tree[i].left, tree[i].right]
        split.append(i)
        leaves += 1
    return split, []


def grow_tree(rows: DataFrame, params: LeafParams, shape: tuple[int, int]) -> dict[int, Node]:
    """One tree from rows ``bins, g, h``, with so many inputs and bins. Leaf values are steps of Newton's method times ``step_size``."""
    hists = _fetched(rows.withColumn("node", F.lit(0)), [0], shape)
    g, h, n = hists[0][0].sum(axis=0)
    tree = {0: Node(0, float(g), float(h), int(n))}
    _note_split(tree[0], hists[0], params)
    while True:
        split, wanted = _best_first(tree, params.num_leaves)
        if not wanted:
            return _pruned(tree, split, params)
        made: list[tuple[int, int, int]] = []  # parent, the child to count, its sibling
        for i in wanted:
            node = tree[i]
            node.left, node.right = len(tree), len(tree) + 1
            tree[node.left] = Node(node.left, *node.low)
            tree[node.right] = Node(node.right, *[a - b for a, b in zip((node.gradient, node.hessian, node.rows), node.low)])
            made.append((i, *sorted((node.left, node.right), key=lambda x: (tree[x].rows, x))))
        # one child of each pair is counted, the other one is the rest of the parent, if its histogram is still held
        asked = [small for _, small, _ in made] + [large for i, _, large in made if i not in hists]
        found = _fetched(rows.withColumn("node", _assigned(tree, F.col("bins"))), asked, shape)
        for i, small, large in made:
            if large not in found:
                found[large] = hists.pop(i) - found[small]
            for child in (small, large):
                _note_split(tree[child], found[child], params)
                if tree[child].gain > 0 and (len(hists) + 1) * shape[0] * shape[1] <= HELD_CELLS:
                    hists[child] = found[child]


def _pruned(tree: Mapping[int, Node], split: Sequence[int], params: LeafParams) -> dict[int, Node]:
    """The tree of the nodes that are split, numbered in the order of splitting."""
    numbers, out = {0: 0}, {}
    for i in split:
        for child in (tree[i].left, tree[i].right):
            numbers[child] = len(numbers)
    for i, new in numbers.items():
        n = tree[i]
        inner = i in set(split)
        value = 0.0 if inner or not n.hessian else -params.step_size * n.gradient / (n.hessian + params.reg_lambda)
        out[new] = Node(
            new, n.gradient, n.hessian, n.rows, n.gain if inner else 0.0, n.feature if inner else None, n.bin if inner else 0,
            n.missing_left if inner else False, numbers[n.left] if inner else None, numbers[n.right] if inner else None, value,
        )
    return out


def _values(tree: Mapping[int, Node], bins: Column, at: int = 0) -> Column:
    node = tree[at]
    if node.left is None:
        return F.lit(node.value)
    b = bins[node.feature]
    left = b.between(1, node.bin) | (b == MISSING_BIN) if node.missing_left else b.between(1, node.bin)
    return F.when(left, _values(tree, bins, node.left)).otherwise(_values(tree, bins, node.right))


def with_gradients(rows: DataFrame, margin: Column) -> DataFrame:
    """``g`` and ``h``, the derivatives of the weighted log-loss, of rows ``y, w`` at a margin."""
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
    return rows.withColumn("g", F.col("w") * (p - F.col("y"))).withColumn("h", F.col("w") * p * (F.lit(1.0) - p))


def train_leafwise(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    params: LeafParams = SEARCH_LEAVES,
    validation: str | None = None,
    borders: Mapping[str, Sequence[float]] | None = None,
) -> LeafModel:
    """Fit on the labelled rows; ``validation`` flags the hold-out, whose AUC after every round tells when to stop.

    Rows whose flag is missing train. A hold-out without both labels has no AUC
    and is an error. Without a flag all ``max_rounds`` rounds are kept. Without
    any row to train on, or only one label, it is an error as well.
    """
    features = list(features)
    labelled = df.filter(F.col(quoted(label)).isNotNull())
    held = F.coalesce(F.col(quoted(validation)).cast("boolean"), F.lit(False)) if validation else F.lit(False)
    borders = {c: list(borders[c]) for c in features} if borders else find_borders(labelled.filter(~held), features, params.max_bins)
    y = F.col(quoted(label)).cast("double")
    weight = F.when(y == 1, F.lit(params.positive_weight)).otherwise(F.lit(1.0))
    key = F.xxhash64(*[F.col(quoted(c)) for c in df.columns], F.lit(params.seed))
    rows = binned(labelled, features, borders, [y.alias("y"), weight.alias("w"), held.alias("held"), key.alias("key")])
    rows = stored(rows)
    positive, all_, held_positive, held_all = rows.agg(
        F.sum(F.when(~F.col("held"), F.col("w") * F.col("y"))), F.sum(F.when(~F.col("held"), F.col("w"))),
        F.count_if(F.col("held") & (F.col("y") == 1)), F.count_if("held"),
    ).first()
    if not positive or positive >= all_:
        raise ValueError("the rows to train on need both labels")
    if validation and not 0 < held_positive < held_all:
        raise ValueError("the hold-out needs both labels")
    model = LeafModel(features, borders, math.log(positive / (all_ - positive)))
    rows = rows.withColumn("margin", F.lit(model.base))
    shape = len(features), 2 + max(len(b) for b in borders.values())
    while len(model.trees) < params.max_rounds:
        margin, margins = F.col("margin"), []
        for _ in range(min(params.block, params.max_rounds - len(model.trees))):
            learned = rows.filter("NOT held")
            if params.bagging_freq and params.bagging_fraction < 1:
                draw = F.pmod(F.xxhash64("key", F.lit(len(model.trees) // params.bagging_freq)), F.lit(1_000_000))
                learned = learned.filter(draw < F.lit(round(params.bagging_fraction * 1_000_000)))
            tree = grow_tree(with_gradients(learned, margin).select("bins", "g", "h"), params, shape)
            model.trees.append(tree)
            margin = margin + _values(tree, F.col("bins"))
            margins.append(margin)
        grown = rows.withColumn("margins", F.array(*margins))
        rows_next = stored(grown.withColumn("margin", F.element_at("margins", -1)))
        if validation:
            found = auc_by_round(rows_next.filter("held"), "margins", "y").orderBy("round").collect()  # one row for each round
            model.auc_per_round += [r["auc"] for r in found]
            best = max(range(len(model.auc_per_round)), key=model.auc_per_round.__getitem__)
            if len(model.auc_per_round) - 1 - best >= params.patience:
                break
        rows = rows_next.drop("margins")
        if len(model.trees[-1]) == 1:  # no leaf can be split any more
            break
    if validation:
        best = max(range(len(model.auc_per_round)), key=model.auc_per_round.__getitem__)
        del model.trees[best + 1 :]
    return model


def auc_by_round(df: DataFrame, scores: str, label: str) -> DataFrame:
    """``round, auc, positives, negatives`` for an array of scores per row, one for each round; rounds count from 0.

    Rows are counted per (round, score) first; one range sort over these serves
    all rounds, because the negatives below a round's first score are those of
    the rounds before it. Equal scores count half. A missing score is the lowest.
    """
    labelled = df.filter(F.col(quoted(label)).isNotNull()).select(F.col(quoted(label)).alias("y"), F.posexplode(scores).alias("round", "score"))
    counted = labelled.groupBy("round", "score").agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    ranked = running_sums(counted, ["round", F.col("score").asc_nulls_first()], {"neg": "neg_before"})
    rounds = ranked.groupBy("round").agg(
        F.sum(F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / F.lit(2.0))).alias("won"),
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"), F.min("neg_before").alias("of_others"),
    )
    won = F.col("won") - F.col("of_others") * F.col("positives").cast("double")
    return rounds.select("round", F.try_divide(won, F.col("positives").cast("double") * F.col("negatives")).alias("auc"), "positives", "negatives")


def score_leafwise(model: LeafModel, df: DataFrame, key: str, name: str = "score", keep: Sequence[str] = ()) -> DataFrame:
    """Probability of class 1 per id, with further columns to keep."""
    margin = model.margin()
    return df.select(quoted(key), *[quoted(c) for c in keep], (F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))).alias(name))


def importances(trees: DataFrame, kind: str = "split") -> DataFrame:
    """``column, importance`` of the inputs that a tree table uses.

    ``split`` counts the nodes that split by the input, ``gain`` sums their gains.
    ``change`` tells how much predictions move with the input: at each of its
    nodes the squared distance of both sides' values from their average, times
    the rows of the side, summed and scaled to a total of 100.
    """
    splits = trees.filter("column IS NOT NULL")
    if kind == "split":
        return splits.groupBy("column").agg(F.count(F.lit(1)).cast("double").alias("importance"))
    if kind == "gain":
        return splits.groupBy("column").agg(F.sum("gain").alias("importance"))
    if kind != "change":
        raise ValueError("importances are of the kinds split, gain and change")
    side = lambda name: trees.select("tree", F.col("node").alias(name), F.col("value").alias(f"{name}_value"), F.col("rows").alias(f"{name}_rows"))
    both = splits.select("tree", "left", "right", "column").join(side("left"), ["tree", "left"]).join(side("right"), ["tree", "right"])
    rows = F.col("left_rows") + F.col("right_rows")
    average = F.try_divide(F.col("left_value") * F.col("left_rows") + F.col("right_value") * F.col("right_rows"), rows)
    moved = F.pow(F.col("left_value") - average, F.lit(2)) * F.col("left_rows") + F.pow(F.col("right_value") - average, F.lit(2)) * F.col("right_rows")
    found = both.groupBy("column").agg(F.sum(moved).alias("moved"))
    total = found.agg(F.sum("moved")).scalar()
    return found.select("column", F.try_divide(F.lit(100.0) * F.col("moved"), total).alias("importance"))


def screened(
    df: DataFrame,
    candidates: Sequence[str],
    label: str,
    margin: Column | None = None,
    params: LeafParams = SEARCH_LEAVES,
    borders: Mapping[str, Sequence[float]] | None = None,
) -> DataFrame:
    """``column, gain``: for each candidate the gain of its own best split against what a margin leaves unexplained.

    The margin is that of the model so far (``LeafModel.margin``), by default the
    share of positive rows. All candidates share one aggregation, and each is
    judged alone, so alike ones do not hide each other. A candidate that cannot be split
    has gain 0. Rows without a label are left out.
    """
    labelled = df.filter(F.col(quoted(label)).isNotNull())
    borders = borders or find_borders(labelled, candidates, params.max_bins)
    y = F.col(quoted(label)).cast("double")
    weight = F.when(y == 1, F.lit(params.positive_weight)).otherwise(F.lit(1.0))
    if margin is None:
        positive, all_ = labelled.agg(F.sum(weight * y), F.sum(weight)).first()
        if not positive or positive >= all_:
            raise ValueError("the rows need both labels")
        margin = F.lit(math.log(positive / (all_ - positive)))
    rows = binned(labelled, candidates, borders, [y.alias("y"), weight.alias("w"), margin.alias("margin")])
    hists = histograms(with_gradients(rows, F.col("margin")).withColumn("node", F.lit(0)))
    best = split_gains(hists, params.min_rows, params.min_hessian, params.reg_lambda).groupBy("f").agg(F.max("gain").alias("gain"))
    names = F.array(*[F.lit(c) for c in candidates])
    all_ = df.sparkSession.range(len(candidates)).select(F.col("id").cast("int").alias("f"))
    gain = F.greatest(F.coalesce("gain", F.lit(0.0)), F.lit(0.0))
    return all_.join(best, "f", "left").select(names[F.col("f")].alias("column"), gain.alias("gain"))
