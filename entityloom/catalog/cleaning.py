"""Cleaning and imputation."""

from pyspark.sql import functions as F

from entityloom.catalog.base import Tables, query, st, stable, stable_columns
from entityloom.functions.scalars import ratio_ieee
from entityloom.operators import clean as K
from entityloom.operators.rollup import group_stats

KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query(
    "clean_sentinels",
    """
    SELECT o_orderkey, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority END AS o_orderpriority,
           coalesce(nullif(o_orderstatus, 'P'), '') AS status, nullif(o_custkey, 0) AS o_custkey
    FROM orders
    """,
)
def clean_sentinels(spark, folder):
    orders = Tables(spark, folder).orders.select(
        "o_orderkey", "o_orderpriority", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"), "o_custkey"
    )
    masked = K.nullify_sentinels(orders, ["4-NOT SPECIFIED"], [0], protect=["o_orderkey"])
    return K.fill_text(masked)


@query(
    "clean_nonfinite",
    """
    SELECT l_orderkey, l_linenumber, CASE WHEN isfinite(ratio) THEN ratio END AS ratio
    FROM (SELECT *, l_quantity / l_discount AS ratio FROM lineitem)
    """,
)
def clean_nonfinite(spark, folder):
    ratio = ratio_ieee(F.col("l_quantity"), F.col("l_discount")).alias("ratio")
    return K.nullify_nonfinite(Tables(spark, folder).lineitem.select("l_orderkey", "l_linenumber", ratio))


@query(
    "impute_mean",
    f"""
    WITH missing AS (SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS discount, nullif(l_tax, 0) AS tax FROM lineitem)
    SELECT l_orderkey, l_linenumber,
           {st("coalesce(discount, (SELECT avg(discount) FROM missing))")} AS discount,
           {st("coalesce(tax, (SELECT avg(tax) FROM missing))")} AS tax
    FROM missing
    """,
)
def impute_mean(spark, folder):
    missing = Tables(spark, folder).lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("discount"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("tax"),
    )
    return stable_columns(K.fill_mean(missing, protect=["l_orderkey", "l_linenumber"]), "discount", "tax")


EVENT_JOIN = """
    SELECT c_custkey, {fill}(n_events, {value}) AS n_events, {fill}(max_value, {value}) AS max_value FROM customer
    LEFT JOIN (SELECT user_id, count(*) AS n_events, max(value) AS max_value FROM events GROUP BY user_id)
    ON user_id = c_custkey
    """


def _event_join(spark, folder):
    t = Tables(spark, folder)
    stats = group_stats(t.events.withColumnRenamed("user_id", "c_custkey"), "c_custkey", {"value": ["max"]}, "n_events")
    return t.customer.select("c_custkey").join(stats, "c_custkey", "left").withColumnRenamed("value_max", "max_value")


@query("impute_zero", EVENT_JOIN.format(fill="coalesce", value=0))
def impute_zero(spark, folder):
    return K.fill_number(_event_join(spark, folder), 0, ["c_custkey"])


@query("impute_marker", EVENT_JOIN.format(fill="coalesce", value=-1))
def impute_marker(spark, folder):
    return K.fill_number(_event_join(spark, folder), -1, ["c_custkey"])


@query(
    "clean_full",
    f"""
    WITH raw AS (
      SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'R') AS flag, l_discount AS discount,
             l_quantity / l_discount AS ratio FROM lineitem),
    masked AS (
      SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN flag = 'N' THEN '' ELSE flag END, '') AS flag,
             nullif(discount, 0) AS discount, CASE WHEN isfinite(ratio) AND ratio <> 0 THEN ratio END AS ratio FROM raw)
    SELECT l_orderkey, l_linenumber, flag,
           {st("coalesce(discount, (SELECT avg(discount) FROM masked))")} AS discount,
           {st("coalesce(ratio, (SELECT avg(ratio) FROM masked))")} AS ratio
    FROM masked
    """,
)
def clean_full(spark, folder):
    raw = Tables(spark, folder).lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("flag"),
        F.col("l_discount").alias("discount"),
        ratio_ieee(F.col("l_quantity"), F.col("l_discount")).alias("ratio"),
    )
    # order 0 exists: the key must not be taken for a sentinel
    cleaned = K.clean(raw, ["l_orderkey", "l_linenumber"], texts=["N"], numbers=[0])
    return stable_columns(cleaned, "discount", "ratio")


@query("column_mean", f"SELECT {st('avg(l_extendedprice)')} AS price, {st('avg(l_discount)')} AS discount FROM lineitem")
def column_mean(spark, folder):
    lines = Tables(spark, folder).lineitem
    return lines.agg(stable(F.avg("l_extendedprice")).alias("price"), stable(F.avg("l_discount")).alias("discount"))
