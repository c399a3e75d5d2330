"""Training, scoring and ranking with Spark's own boosted trees, and their metrics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark import SparkContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entityloom.operators.ordering import running_sums
from entityloom.plans import cells
from entityloom.session import ensure_checkpoint_dir, largest_task, stored


@dataclass(frozen=True)
class BoostingParams:
    """What the trainer is told; ``max_depth`` d allows 2**d leaves.

    With a hold-out, rounds are added in blocks that double from
    ``first_rounds`` on, until the best round is ``patience`` rounds back or
    ``max_iter`` is reached; the model keeps the rounds up to the best one.
    """

    step_size: float = 0.1
    max_depth: int = 5
    max_iter: int = 10_000
    patience: int = 100
    first_rounds: int = 50
    subsampling_rate: float = 0.8
    min_instances: int = 100
    positive_weight: float = 12.0
    max_bins: int = 32
    seed: int = 42

    def with_(self, **changes) -> BoostingParams:
        return replace(self, **changes)


# Learning rate, rounds, patience, leaves (as depth), bagging, leaf size and weight in use.
LARGE_TREES = BoostingParams(0.01, 9, 5_000, 100, subsampling_rate=0.8, min_instances=50, positive_weight=1.0)
SMALL_TREES = BoostingParams(0.01, 5, 10_000, 100, subsampling_rate=0.8, min_instances=100, positive_weight=12.0)
SEARCH_TREES = BoostingParams(0.1, 5, 10_000, 50, subsampling_rate=0.8, min_instances=100, positive_weight=12.0)
ORDERED_TREES = BoostingParams(0.01, 10, 10_000, 100, subsampling_rate=0.8, min_instances=100, positive_weight=1.0)


# The trainer keeps a task's rows in memory; a row takes ROW_BYTES (measured) there and four bytes for each input.
TASK_BYTES = 128 << 20
ROW_BYTES = 232


def assemble_vector(df: DataFrame, features: Sequence[str], keep: Sequence[str], output: str = "features") -> DataFrame:
    """The model inputs as one vector, with the columns to keep beside it."""
    assembler = VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="keep")
    return assembler.transform(df).select(*keep, output)


def train_boosted(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    params: BoostingParams = SEARCH_TREES,
    validation: str | None = None,
) -> GBTClassificationModel:
    """Fit on the labelled rows; ``validation`` flags the hold-out that tells when to stop.

    Rows whose flag is missing train. The trainer itself stops at the first
    round that does not improve, so it never gets the flag: the model is fitted
    without the hold-out, its loss there is taken after every round, and while
    the best round is among the last ``patience`` ones, twice as many rounds
    are fitted. The model is then cut to the best round, without another fit.
    Without a hold-out all ``max_iter`` rounds are kept. No task of a fit gets
    more rows than take ``TASK_BYTES`` in the trainer. Where the bins of few
    inputs have fewer combinations than there are rows, the rows are counted by
    their bins (``cells``) and no longer kept one by one.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keep = [F.col(label).cast("double").alias("label")]
    keep.append(F.when(F.col(label) == 1, F.lit(params.positive_weight)).otherwise(F.lit(1.0)).alias("weight"))
    if validation:
        keep.append(F.coalesce(F.col(validation).cast("boolean"), F.lit(False)).alias("validation"))
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    rows = assembler.transform(df.filter(F.col(label).isNotNull())).select(*keep, "features")
    trainer = GBTClassifier(
        labelCol="label",
        featuresCol="features",
        weightCol="weight",
        stepSize=params.step_size,
        maxDepth=params.max_depth,
        subsamplingRate=params.subsampling_rate,
        minInstancesPerNode=params.min_instances,
        maxBins=params.max_bins,
        seed=params.seed,
        checkpointInterval=10,
        maxMemoryInMB=1024,
    )
    if cells.fits(df, features, label, params.max_bins):
        return cells.train_on_cells(
            df, features, label, trainer.setMaxIter(params.max_iter), params.positive_weight, validation, params.first_rounds, params.patience
        )
    most = max(1, TASK_BYTES // (ROW_BYTES + 4 * len(features)))
    if not validation:
        if largest_task(rows) > most:
            rows = stored(rows, rows_per_task=most)
        return trainer.setMaxIter(params.max_iter).fit(rows)
    # read once for every round of every fit
    rows = stored(rows, rows_per_task=most)
    learned, held = rows.filter("NOT validation"), rows.filter("validation")
    if not held.take(1):
        raise ValueError("the hold-out has no labelled row")
    rounds = min(params.first_rounds, params.max_iter)
    while True:
        model = trainer.setMaxIter(rounds).fit(learned)
        losses = model.evaluateEachIteration(held)
        best = min(range(len(losses)), key=losses.__getitem__) + 1
        if rounds - best >= params.patience or rounds >= params.max_iter:
            break
        rounds = min(2 * rounds, params.max_iter)
    return first_rounds(model, best)


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model of the first trees only; nothing is fitted."""
    if rounds >= model.getNumTrees:
        return model
    whole = model._java_obj
    jvm = SparkContext._active_spark_context._jvm
    gateway = SparkContext._active_spark_context._gateway
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(jvm.double, rounds)
    all_trees, all_weights = whole.trees(), whole.treeWeights()
    for i in range(rounds):
        trees[i], weights[i] = all_trees[i], all_weights[i]
    kind = jvm.org.apache.spark.ml.classification.GBTClassificationModel
    cut = kind(whole.uid(), trees, weights, whole.numFeatures(), whole.numClasses())
    whole.copyValues(cut, whole.extractParamMap())
    return GBTClassificationModel(cut)


def score(
    model: GBTClassificationModel, df: DataFrame, features: Sequence[str], key: str, name: str = "score", keep: Sequence[str] = ()
) -> DataFrame:
    """Probability of class 1 per id, with further columns to keep."""
    scored = model.transform(assemble_vector(df, features, [key, *keep]))
    return scored.select(key, *keep, vector_to_array("probability")[1].alias(name))


def importance_table(model: GBTClassificationModel, features: Sequence[str], df: DataFrame) -> DataFrame:
    """(column, importance), one row per model input."""
    schema = T.StructType([T.StructField("column", T.StringType()), T.StructField("importance", T.DoubleType())])
    rows = [(c, float(v)) for c, v in zip(features, model.featureImportances.toArray())]
    return df.sparkSession.createDataFrame(rows, schema)


def rank_features(
    df: DataFrame, features: Sequence[str], label: str, params: BoostingParams = SEARCH_TREES, validation: str | None = None
) -> DataFrame:
    """Importances of a model fitted for the purpose."""
    return importance_table(train_boosted(df, features, label, params, validation), features, df)


def auc(df: DataFrame, score_column: str, label: str) -> DataFrame:
    """Area under the ROC curve: the share of (positive, negative) pairs in the right order.

    Rows are counted per distinct score first; equal scores count half.
    """
    counted = (
        df.filter(F.col(label).isNotNull())
        .groupBy(score_column)
        .agg(F.count_if(F.col(label) == 1).alias("__pos"), F.count_if(F.col(label) == 0).alias("__neg"))
    )
    ranked = running_sums(counted, [score_column], {"__neg": "__neg_below"})
    won = F.sum(F.col("__pos").cast("double") * (F.col("__neg_below") + F.col("__neg") / F.lit(2.0)))
    positives, negatives = F.sum("__pos"), F.sum("__neg")
    return ranked.agg(
        F.try_divide(won, positives.cast("double") * negatives.cast("double")).alias("auc"),
        positives.alias("positives"),
        negatives.alias("negatives"),
    )


def log_loss_column(probability: Column, label: Column, epsilon: float = 1e-15) -> Column:
    p = F.greatest(F.lit(epsilon), F.least(F.lit(1 - epsilon), probability))
    return F.when(label == 1, -F.log(p)).otherwise(-F.log(F.lit(1.0) - p))


def log_loss(df: DataFrame, probability: str, label: str) -> DataFrame:
    """Mean negative log likelihood of the labelled rows."""
    labelled = df.filter(F.col(label).isNotNull())
    return labelled.agg(F.avg(log_loss_column(F.col(probability), F.col(label))).alias("logloss"))


def confusion(df: DataFrame, probability: str, label: str, threshold: float = 0.5) -> DataFrame:
    """Rows per (label, prediction)."""
    predicted = F.when(F.col(probability) >= threshold, F.lit(1)).otherwise(F.lit(0))
    return (
        df.filter(F.col(label).isNotNull())
        .groupBy(F.col(label).alias("label"), predicted.alias("prediction"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def accuracy(df: DataFrame, probability: str, label: str, threshold: float = 0.5) -> DataFrame:
    right = (F.col(probability) >= threshold).cast("int") == F.col(label)
    return df.filter(F.col(label).isNotNull()).agg(F.avg(right.cast("double")).alias("accuracy"))


def principal_components(df: DataFrame, columns: Sequence[str], k: int, keep: Sequence[str]) -> DataFrame:
    """The first k principal components as columns ``pc_1`` to ``pc_k``.

    A missing or non-finite cell is an error (fill it first), as it would make
    every component NaN. The sign of a component is such that its largest
    weight is positive.
    """
    assembler = VectorAssembler(inputCols=list(columns), outputCol="input", handleInvalid="error")
    vectors = assembler.transform(df).select(*keep, "input")
    model = PCA(k=k, inputCol="input", outputCol="output").fit(vectors)
    weights = model.pc.toArray()
    signs = [1.0 if max(w, key=abs) >= 0 else -1.0 for w in weights.T.tolist()]
    parts = vector_to_array("output")
    return model.transform(vectors).select(*keep, *[(parts[i] * F.lit(signs[i])).alias(f"pc_{i + 1}") for i in range(k)])
