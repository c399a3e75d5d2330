"""Scalar features over pairs of columns, single and in sets."""

from pyspark.sql import functions as F

from entityloom.catalog.base import Tables, all_stable, query, st, stable, stable_columns
from entityloom.functions import scalars as S
from entityloom.operators.rollup import feature_block, group_stats
from entityloom.plans.replay import FeatureSpec, apply_specs

LINE = "l_orderkey, l_linenumber"
# zero denominators, and missing ones (where the tax is zero)
DENOMINATOR = "CASE WHEN l_tax = 0 THEN NULL ELSE l_discount END"


def _lines(spark, folder):
    denominator = F.when(F.col("l_tax") != 0, F.col("l_discount"))
    return Tables(spark, folder).lineitem.withColumn("b", denominator)


@query(
    "ratio_ieee",
    f"""
    SELECT {LINE}, CASE WHEN b = 0 AND l_quantity = 0 THEN NULL ELSE l_quantity / b END AS quantity_over_discount
    FROM (SELECT *, {DENOMINATOR} AS b FROM lineitem)
    """,
)
def ratio_ieee(spark, folder):
    ratio = S.ratio_ieee(F.col("l_quantity"), F.col("b"))
    return _lines(spark, folder).select("l_orderkey", "l_linenumber", ratio.alias("quantity_over_discount"))


@query(
    "ratio_null",
    f"""
    SELECT {LINE}, l_quantity / nullif(b, 0) AS quantity_over_discount
    FROM (SELECT *, {DENOMINATOR} AS b FROM lineitem)
    """,
)
def ratio_null(spark, folder):
    ratio = S.ratio_null(F.col("l_quantity"), F.col("b"))
    return _lines(spark, folder).select("l_orderkey", "l_linenumber", ratio.alias("quantity_over_discount"))


@query(
    "ratio_clamped",
    f"""
    SELECT {LINE}, l_extendedprice / greatest(1.0::DOUBLE, coalesce(nullif(l_quantity, 7), 1)) AS unit_price,
           l_quantity / greatest(1.0::DOUBLE, coalesce(b, 1)) AS quantity_over_discount
    FROM (SELECT *, {DENOMINATOR} AS b FROM lineitem)
    """,
)
def ratio_clamped(spark, folder):
    seven_missing = F.nullif(F.col("l_quantity"), F.lit(7.0))
    return _lines(spark, folder).select(
        "l_orderkey",
        "l_linenumber",
        S.ratio_clamped(F.col("l_extendedprice"), seven_missing).alias("unit_price"),
        S.ratio_clamped(F.col("l_quantity"), F.col("b")).alias("quantity_over_discount"),
    )


@query(
    "ratio_guarded",
    f"""
    SELECT {LINE}, CASE WHEN b = 0 THEN l_quantity ELSE l_quantity / b END AS quantity_over_discount
    FROM (SELECT *, {DENOMINATOR} AS b FROM lineitem)
    """,
)
def ratio_guarded(spark, folder):
    ratio = S.ratio_guarded(F.col("l_quantity"), F.col("b"))
    return _lines(spark, folder).select("l_orderkey", "l_linenumber", ratio.alias("quantity_over_discount"))


def _pair(name, function, sql, exact=False):
    """``exact`` results are the same in all engines to the last bit and are compared uncut."""

    @query(name, f"SELECT {LINE}, {sql if exact else st(sql)} AS feature FROM lineitem")
    def run(spark, folder):
        feature = function(F.col("l_quantity"), F.col("l_extendedprice"))
        return Tables(spark, folder).lineitem.select("l_orderkey", "l_linenumber", (feature if exact else stable(feature)).alias("feature"))

    return run


_pair("pair_sum", S.pair_sum, "l_quantity + l_extendedprice", exact=True)
_pair("pair_diff", S.pair_diff, "l_quantity - l_extendedprice", exact=True)
_pair("pair_product", S.pair_product, "l_quantity * l_extendedprice", exact=True)
_pair("pair_norm", S.pair_norm, "sqrt(l_quantity * l_quantity + l_extendedprice * l_extendedprice)")
_pair("pair_angle", S.pair_angle, "atan2(l_quantity, l_extendedprice)")


PARENT_SET = (
    FeatureSpec("acctbal_over_mean_price", "ratio_clamped", ("c_acctbal", "mean_price")),
    FeatureSpec("max_price_over_mean_price", "ratio_clamped", ("max_price", "mean_price")),
    FeatureSpec("mean_price_over_n_orders", "ratio_clamped", ("mean_price", "n_orders")),
    FeatureSpec("max_price_over_acctbal", "ratio_clamped", ("max_price", "c_acctbal")),
    FeatureSpec("acctbal_over_n_orders", "ratio_ieee", ("c_acctbal", "n_orders")),
    FeatureSpec("max_price_minus_mean_price", "diff", ("max_price", "mean_price")),
    FeatureSpec("max_price_minus_acctbal", "diff", ("max_price", "c_acctbal")),
)


@query(
    "feature_set_parent",
    f"""
    WITH joined AS (
      SELECT c_custkey, c_acctbal, n_orders, mean_price, max_price FROM customer
      LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, avg(o_totalprice) AS mean_price, max(o_totalprice) AS max_price
                 FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey)
    SELECT c_custkey,
      {st("c_acctbal / greatest(1.0::DOUBLE, coalesce(mean_price, 1))")} AS acctbal_over_mean_price,
      {st("max_price / greatest(1.0::DOUBLE, coalesce(mean_price, 1))")} AS max_price_over_mean_price,
      {st("mean_price / greatest(1.0::DOUBLE, coalesce(n_orders, 1))")} AS mean_price_over_n_orders,
      {st("max_price / greatest(1.0::DOUBLE, c_acctbal)")} AS max_price_over_acctbal,
      {st("c_acctbal / n_orders")} AS acctbal_over_n_orders,
      {st("max_price - mean_price")} AS max_price_minus_mean_price,
      {st("max_price - c_acctbal")} AS max_price_minus_acctbal
    FROM joined
    """,
)
def feature_set_parent(spark, folder):
    t = Tables(spark, folder)
    totals = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.avg("o_totalprice").alias("mean_price"),
        F.max("o_totalprice").alias("max_price"),
    )
    joined = t.customer.select("c_custkey", "c_acctbal").join(totals, "c_custkey", "left")
    return all_stable(apply_specs(joined, PARENT_SET).select("c_custkey", *[s.name for s in PARENT_SET]))


CHILD_SET = (
    FeatureSpec("quantity_over_discount", "ratio_ieee", ("l_quantity", "l_discount")),
    FeatureSpec("price_over_quantity", "ratio_ieee", ("l_extendedprice", "l_quantity")),
    FeatureSpec("quantity_over_tax", "ratio_ieee", ("l_quantity", "l_tax")),
)


def _filled(column: str, source: str) -> str:
    return f"avg(CASE WHEN isfinite({column}) THEN {column} ELSE (SELECT avg({column}) FROM {source} WHERE isfinite({column})) END)"


@query(
    "feature_set_child",
    f"""
    WITH lines AS (
      SELECT l_orderkey, l_quantity / l_discount AS quantity_over_discount,
             l_extendedprice / l_quantity AS price_over_quantity, l_quantity / l_tax AS quantity_over_tax FROM lineitem),
    backed AS (
      SELECT *, {", ".join(f"{f}({c}) OVER (PARTITION BY l_orderkey) AS {c}_{n}"
                           for c in ("quantity_over_discount", "price_over_quantity", "quantity_over_tax")
                           for f, n in (("avg", "mean"), ("min", "min"), ("max", "max")))}
      FROM lines)
    SELECT l_orderkey, count(*) AS n_lines,
      {", ".join(st(_filled(c + s, "backed")) + " AS " + c + s
                 for c in ("quantity_over_discount", "price_over_quantity", "quantity_over_tax")
                 for s in ("", "_mean", "_min", "_max"))}
    FROM backed GROUP BY l_orderkey
    """,
)
def feature_set_child(spark, folder):
    lines = apply_specs(Tables(spark, folder).lineitem, CHILD_SET)
    return all_stable(feature_block(lines, "l_orderkey", "n_lines", [s.name for s in CHILD_SET], "mean"))


@query(
    "feature_set_diff",
    """
    SELECT l_orderkey, l_linenumber, l_quantity,
           CAST(date_diff('day', o_orderdate, l_shipdate) AS DOUBLE) AS ship_minus_order,
           l_extendedprice - l_extendedprice * (1 - l_discount) AS price_minus_discounted
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    """,
)
def feature_set_diff(spark, folder):
    t = Tables(spark, folder)
    joined = t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    days = joined.select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.unix_date(F.to_date("l_shipdate")).alias("ship"),
        F.unix_date(F.to_date("o_orderdate")).alias("order"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).alias("discounted"),
    )
    specs = [FeatureSpec(f"{a}_minus_{b}", "diff", (a, b)) for a, b in (("ship", "order"), ("price", "discounted"))]
    return apply_specs(days, specs).drop("ship", "order", "price", "discounted")


CHAIN = (
    FeatureSpec("f_0", "product", ("l_quantity", "l_discount")),
    FeatureSpec("f_1", "angle", ("f_0", "l_quantity")),
    FeatureSpec("f_2", "ratio_guarded", ("l_extendedprice", "f_0")),
    FeatureSpec("f_3", "norm", ("f_1", "f_2")),
    FeatureSpec("f_4", "sum", ("f_3", "l_tax")),
)


@query(
    "feature_chained",
    f"""
    WITH a AS (SELECT *, l_quantity * l_discount AS f_0 FROM lineitem),
    b AS (SELECT *, atan2(f_0, l_quantity) AS f_1,
                 CASE WHEN f_0 = 0 THEN l_extendedprice ELSE l_extendedprice / f_0 END AS f_2 FROM a),
    c AS (SELECT *, sqrt(f_1 * f_1 + f_2 * f_2) AS f_3 FROM b)
    SELECT l_orderkey, l_linenumber, {", ".join(f"{st(f)} AS {f}" for f in ("f_0", "f_1", "f_2", "f_3"))},
           {st("f_3 + l_tax")} AS f_4 FROM c
    """,
)
def feature_chained(spark, folder):
    featured = apply_specs(Tables(spark, folder).lineitem, CHAIN)
    return featured.select("l_orderkey", "l_linenumber", *[stable(s.name).alias(s.name) for s in CHAIN])


@query(
    "freq_feature",
    """
    SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey, o_orderstatus) AS freq FROM orders
    """,
)
def freq_feature(spark, folder):
    spec = FeatureSpec("freq", "group_count", ("o_custkey", "o_orderstatus"))
    return apply_specs(Tables(spark, folder).orders, [spec]).select("o_orderkey", "freq")


@query(
    "std_feature",
    f"""
    SELECT o_orderkey, {st("stddev_samp(o_totalprice) OVER (PARTITION BY o_custkey)")} AS price_std FROM orders
    """,
)
def std_feature(spark, folder):
    spec = FeatureSpec("price_std", "group_std", ("o_custkey", "o_totalprice"))
    return apply_specs(Tables(spark, folder).orders, [spec]).select("o_orderkey", stable("price_std").alias("price_std"))


@query(
    "group_size_feature",
    "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type",
)
def group_size_feature(spark, folder):
    return group_stats(Tables(spark, folder).events, ["user_id", "event_type"], {}, "n")


MANY = [FeatureSpec(f"std_{c}", "group_std", ("l_orderkey", c)) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")] + [
    FeatureSpec("n_part_supplier", "group_count", ("l_partkey", "l_suppkey")),
    FeatureSpec("n_supplier_part", "group_count", ("l_suppkey", "l_partkey")),
]


@query(
    "group_features_many",
    f"""
    SELECT {LINE}, l_partkey, l_suppkey, {", ".join(
        f"{st(f'stddev_samp({c}) OVER (PARTITION BY l_orderkey)')} AS std_{c}" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))},
      count(*) OVER (PARTITION BY l_partkey, l_suppkey) AS n_part_supplier, count(*) OVER (PARTITION BY l_partkey, l_suppkey) AS n_supplier_part
    FROM lineitem
    """,
)
def group_features_many(spark, folder):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    wide = apply_specs(Tables(spark, folder).lineitem.select(*columns), MANY)
    names = [s.name for s in MANY]
    return stable_columns(wide.select(*columns[:4], *names), *names[:4])
