"""Metrics of a fixed score, and models (without SQL: training is iterative)."""

from pyspark.sql import functions as F

from entityloom.catalog.base import Tables, all_stable, query, st, stable_columns
from entityloom.catalog.pipelines import customer_table
from entityloom.operators.split import hash_bucket, with_hold_out
from entityloom.plans import boosting as B
from entityloom.plans import scoring as M
from entityloom.plans.search import explore
from entityloom.schema import numeric_columns
from entityloom.session import stored

TARGET = "CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END"
PROBABILITY = "(c_nationkey + 1) / 40.0::DOUBLE"
SCORED = f"SELECT c_custkey, {TARGET} AS target, {PROBABILITY} AS p FROM customer"


def _scored(spark, folder):
    return Tables(spark, folder).customer.select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("target"),
        ((F.col("c_nationkey") + F.lit(1)).cast("double") / F.lit(40.0)).alias("p"),
    )


@query("logloss", f"SELECT {st('avg(CASE WHEN target = 1 THEN -ln(p) ELSE -ln(1 - p) END)')} AS logloss FROM ({SCORED})")
def logloss(spark, folder):
    return all_stable(M.log_loss(_scored(spark, folder), "p", "target"))


@query(
    "confusion",
    f"""
    SELECT target AS label, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS prediction, count(*) AS n_rows FROM ({SCORED}) GROUP BY ALL
    """,
)
def confusion(spark, folder):
    return M.confusion(_scored(spark, folder), "p", "target")


@query(
    "accuracy",
    f"SELECT {st('avg(CASE WHEN (p >= 0.5) = (target = 1) THEN 1.0::DOUBLE ELSE 0 END)')} AS accuracy FROM ({SCORED})",
)
def accuracy(spark, folder):
    return all_stable(M.accuracy(_scored(spark, folder), "p", "target"))


def _auc_sql(scored: str) -> str:
    return f"""
    WITH scored AS ({scored}),
    ranked AS (SELECT target, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0::DOUBLE AS r FROM scored),
    sums AS (SELECT sum(CASE WHEN target = 1 THEN r END) AS rank_sum, count(CASE WHEN target = 1 THEN 1 END) AS positives,
                    count(CASE WHEN target = 0 THEN 1 END) AS negatives FROM ranked)
    SELECT {st("(rank_sum - positives * (positives + 1) / 2.0::DOUBLE) / (positives * negatives)")} AS auc, positives, negatives
    FROM sums
    """


@query("auc_rank", _auc_sql(SCORED))
def auc_rank(spark, folder):
    return stable_columns(M.auc(_scored(spark, folder), "p", "target"), "auc")


@query(
    "auc_lines",
    _auc_sql("SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS target, l_extendedprice AS p FROM lineitem"),
)
def auc_lines(spark, folder):
    target = F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("target")
    scored = Tables(spark, folder).lineitem.select(target, F.col("l_extendedprice").alias("p"))
    return stable_columns(M.auc(scored, "p", "target"), "auc")


# small tables: smaller leaves, and the first look after fewer rounds
TREES = M.SEARCH_TREES.with_(min_instances=20, first_rounds=20, patience=10)


def _trained(spark, folder):
    """The model of the wide customer table; the balance itself would give the label away."""
    wide = customer_table(spark, folder).drop("c_acctbal", "o_totalprice_over_c_acctbal")
    flagged = stored(with_hold_out(wide, hash_bucket(["c_custkey"], 1000), 0.10, buckets=1000))
    inputs = numeric_columns(wide, ["c_custkey", "target"])
    return flagged, inputs, M.train_boosted(flagged, inputs, "target", TREES, "is_validation")


ROUND_SCORES = ["l_discount", "l_discount + l_tax", "l_discount + l_tax + l_quantity / 100"]
_RETURNED = "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END"


@query(
    "auc_rounds",
    " UNION ALL ".join(
        f"SELECT {i} AS round, * FROM ({_auc_sql(f'SELECT {_RETURNED} AS target, {p} AS p FROM lineitem')})" for i, p in enumerate(ROUND_SCORES)
    ),
)
def auc_rounds(spark, folder):
    """The AUC of every prefix of a sum of scores, as boosting looks at its rounds."""
    lines = Tables(spark, folder).lineitem
    scored = lines.select(F.expr(_RETURNED).alias("target"), F.array(*[F.expr(p) for p in ROUND_SCORES]).alias("scores"))
    return stable_columns(B.auc_by_round(scored, "scores", "target"), "auc")


# borders between the bins of the screened columns, and the columns as SQL
SCREEN_BORDERS = {
    "quantity": [10.0, 20.0, 30.0, 40.0],
    "price": [10_000.0, 20_000.0, 40_000.0, 60_000.0],
    "discount": [0.015, 0.035, 0.055, 0.085],
    "late": [0.0, 20.0, 40.0, 80.0],
}
SCREEN_COLUMNS = {
    "quantity": "l_quantity",
    "price": "l_extendedprice",
    "discount": "nullif(l_discount, 0)",
    "late": "CAST(year(l_shipdate) * 12 + month(l_shipdate) - 23900 AS DOUBLE)",
}
SCREEN_PARAMS = B.LeafParams(min_rows=5)


def _gain(low: str, g: str = "sum(p - y)", h: str = "sum(p * (1 - p))") -> str:
    term = lambda where: f"coalesce(pow({g} FILTER (WHERE {where}), 2) / ({h} FILTER (WHERE {where})), 0)"
    return (
        f"CASE WHEN least(count(*) FILTER (WHERE {low}), count(*) FILTER (WHERE NOT ({low}))) >= 5 "
        f"THEN {term(low)} + {term(f'NOT ({low})')} - pow({g}, 2) / {h} ELSE 0 END"
    )


_SCREENED = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {_gain(f'coalesce({c} <= {b}, {missing})')} AS gain FROM rows"
    for c, borders in SCREEN_BORDERS.items()
    for b in ("-1e300", *borders, "1e300")
    for missing in ("false", "true")
)


@query(
    "screen_candidates",
    f"""
    WITH lines AS (SELECT {", ".join(f"{e} AS {c}" for c, e in SCREEN_COLUMNS.items())}, CAST({_RETURNED} AS DOUBLE) AS y FROM lineitem),
    rows AS (SELECT *, (SELECT avg(y) FROM lines) AS p FROM lines)
    SELECT "column", {st("round(greatest(max(gain), 0), 4)")} AS gain FROM ({_SCREENED}) GROUP BY ALL
    """,
)
def screen_candidates(spark, folder):
    """The gain of each column's own best split of returned lines, missing values on the better side."""
    lines = Tables(spark, folder).lineitem
    rows = lines.select(*[F.expr(e).alias(c) for c, e in SCREEN_COLUMNS.items()], F.expr(_RETURNED).alias("y"))
    found = B.screened(rows, list(SCREEN_COLUMNS), "y", params=SCREEN_PARAMS, borders=SCREEN_BORDERS)
    return stable_columns(found.withColumn("gain", F.round("gain", 4)), "gain")


@query("leafwise_score")
def leafwise_score(spark, folder):
    """Scores of leaf-wise trees on the wide customer table, stopped by the AUC of the hold-out."""
    wide = customer_table(spark, folder).drop("c_acctbal", "o_totalprice_over_c_acctbal")
    flagged = stored(with_hold_out(wide, hash_bucket(["c_custkey"], 1000), 0.10, buckets=1000))
    inputs = numeric_columns(wide, ["c_custkey", "target"])
    params = B.SEARCH_LEAVES.with_(num_leaves=15, min_rows=20, max_rounds=6, block=3)
    return B.score_leafwise(B.train_leafwise(flagged, inputs, "target", params, "is_validation"), flagged, "c_custkey")


@query("gbt_score")
def gbt_score(spark, folder):
    wide, inputs, model = _trained(spark, folder)
    return M.score(model, wide, inputs, "c_custkey")


@query("gbt_importance")
def gbt_importance(spark, folder):
    wide, inputs, model = _trained(spark, folder)
    return M.importance_table(model, inputs, wide)


LINE_INPUTS = ["l_extendedprice", "l_discount", "l_tax", "l_quantity"]
# a label that follows from the inputs gets better with every round, so this search for the best one has an end
SUMMARY_TREES = TREES.with_(max_iter=20, max_depth=3)


@query(
    "gbt_summary",
    """
    SELECT count(*) AS rows_scored, 0::BIGINT AS missing, 0::BIGINT AS outside, true AS more_than_one_tree, true AS better_than_chance,
           1.0::DOUBLE AS importances
    FROM lineitem
    """,
)
def gbt_summary(spark, folder):
    """A model of what lines cost after their discount, judged on lines of orders it has not seen."""
    lines = Tables(spark, folder).lineitem.select(
        "l_orderkey", *LINE_INPUTS, F.when(F.col("l_extendedprice") * (1 - F.col("l_discount")) > 45_000, 1).otherwise(0).alias("target")
    )
    flagged = stored(with_hold_out(lines, hash_bucket(["l_orderkey"], 1000), 0.1, buckets=1000))
    model = M.train_boosted(flagged, LINE_INPUTS, "target", SUMMARY_TREES, "is_validation")
    judged = stored(M.score(model, flagged, LINE_INPUTS, "l_orderkey", keep=["target", "is_validation"]))
    held_auc = M.auc(judged.filter("is_validation"), "score", "target").select((F.col("auc") > 0.6).alias("better_than_chance"))
    importances = M.importance_table(model, LINE_INPUTS, flagged).agg(F.round(F.sum("importance"), 6).alias("importances"))
    scored = judged.agg(
        F.count(F.lit(1)).alias("rows_scored"),
        F.count_if(F.col("score").isNull()).alias("missing"),
        F.count_if(~F.col("score").between(0, 1)).alias("outside"),
        F.lit(model.getNumTrees > 1).alias("more_than_one_tree"),
    )
    return scored.select("*", held_auc.scalar().alias("better_than_chance"), importances.scalar().alias("importances"))


@query("feature_search")
def feature_search(spark, folder):
    t = Tables(spark, folder)
    label = F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("target")
    lines = t.lineitem.select("l_orderkey", label, "l_linestatus", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    found = explore(
        lines, "l_orderkey", "target", "lines", target=4, params=TREES
    )
    return found.table


@query("pca_features")
def pca_features(spark, folder):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return M.principal_components(Tables(spark, folder).lineitem, columns, 2, ["l_orderkey", "l_linenumber"])
