"""Profiles, ranks, prefixes, splits."""

from pyspark.sql import functions as F

from entityloom.catalog.base import Tables, all_stable, query, st, stable_columns
from entityloom.operators import ordering as O
from entityloom.operators import profile as P
from entityloom.operators import sketches as K
from entityloom.operators.rollup import group_stats
from entityloom.operators.split import arithmetic_bucket, with_hold_out, with_ordered_hold_out
from entityloom.sources.tables import scan_prefix

PROFILED = ["c_mktsegment", "c_nationkey", "n_orders"]


@query(
    "target_profile",
    f"""
    WITH t AS (
      SELECT c_mktsegment, c_nationkey, n_orders, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS target FROM customer
      LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey)
    {" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, {st('avg(target)')} AS target_mean, "
        f"count(target) AS target_count FROM t WHERE {c} IS NOT NULL GROUP BY {c}" for c in PROFILED)}
    """,
)
def target_profile(spark, folder):
    t = Tables(spark, folder)
    counts = group_stats(t.orders.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", {}, "n_orders")
    target = F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("target")
    joined = t.customer.select("c_custkey", "c_mktsegment", "c_nationkey", target).join(counts, "c_custkey", "left")
    return stable_columns(P.target_profile(joined, "target", PROFILED), "target_mean")


SUMMARISED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "summary_stats",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, {st(f"avg({c})")} AS mean, {st(f"stddev_samp({c})")} AS std,
        min({c}) AS min, {st(f"quantile_cont({c}, 0.25)")} AS p25, {st(f"quantile_cont({c}, 0.5)")} AS p50,
        {st(f"quantile_cont({c}, 0.75)")} AS p75, max({c}) AS max FROM lineitem"""
        for c in SUMMARISED
    ),
)
def summary_stats(spark, folder):
    summary = P.summary_stats(Tables(spark, folder).lineitem, SUMMARISED)
    return stable_columns(summary, "mean", "std", "p25", "p50", "p75")


@query(
    "positive_rate", f"SELECT {st('avg(CASE WHEN c_acctbal < 0 THEN 1.0::DOUBLE ELSE 0 END)')} AS positive_rate FROM customer"
)
def positive_rate(spark, folder):
    flagged = Tables(spark, folder).customer.select(F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("target"))
    return all_stable(P.positive_rate(flagged, "target"))


@query(
    "minmax_scale",
    f"""
    SELECT c_custkey,
      {st("(c_acctbal - (SELECT min(c_acctbal) FROM customer)) / (SELECT max(c_acctbal) - min(c_acctbal) FROM customer)")} AS c_acctbal,
      {st("(c_nationkey - (SELECT min(c_nationkey) FROM customer)) / (SELECT max(c_nationkey) - min(c_nationkey) FROM customer)")} AS c_nationkey
    FROM customer
    """,
)
def minmax_scale(spark, folder):
    customer = Tables(spark, folder).customer.select("c_custkey", "c_acctbal", "c_nationkey")
    return all_stable(P.min_max_scale(customer, ["c_acctbal", "c_nationkey"]))


@query(
    "low_variance",
    f"""
    SELECT * FROM (SELECT 'l_discount' AS "column", {st("var_pop(l_discount)")} AS variance FROM lineitem
    UNION ALL SELECT 'l_tax' AS "column", {st("var_pop(l_tax)")} AS variance FROM lineitem
    UNION ALL SELECT 'l_quantity' AS "column", {st("var_pop(l_quantity)")} AS variance FROM lineitem) WHERE variance <= 0.01
    """,
)
def low_variance(spark, folder):
    return all_stable(P.low_variance(Tables(spark, folder).lineitem, ["l_discount", "l_tax", "l_quantity"], 0.01))


@query("topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def topk(spark, folder):
    return O.top(Tables(spark, folder).orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 20, ["o_orderkey"])


@query(
    "topk_member",
    """
    SELECT coalesce(max(CASE WHEN p_type = (SELECT p_type FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 1)
                             THEN 1 END), 0) AS in_top
    FROM (SELECT p_type, sum(l_quantity) AS quantity FROM lineitem JOIN part ON p_partkey = l_partkey
          GROUP BY p_type ORDER BY quantity DESC, p_type LIMIT 20)
    """,
)
def topk_member(spark, folder):
    t = Tables(spark, folder)
    dearest = t.part.orderBy(F.col("p_retailprice").desc(), "p_partkey").limit(1).select("p_type")
    per_part = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_quantity").alias("quantity"))
    per_type = t.part.select("p_partkey", "p_type").join(per_part, "p_partkey").groupBy("p_type").agg(
        F.sum("quantity").alias("quantity")
    )
    return O.in_top(per_type, "quantity", 20, ["p_type"], "p_type", dearest.scalar())


@query("limit_prefix", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100")
def limit_prefix(spark, folder):
    return O.first_rows(Tables(spark, folder).orders.select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"], 100)


@query(
    "sample_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(o_orderkey::VARCHAR), o_orderkey LIMIT 100",
)
def sample_rows(spark, folder):
    return O.sample_rows(Tables(spark, folder).orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 100)


@query(
    "row_positions",
    """
    SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS position FROM customer
    """,
)
def row_positions(spark, folder):
    customer = Tables(spark, folder).customer.select("c_custkey", "c_acctbal")
    return O.number_rows(customer, ["c_acctbal", "c_custkey"], "position")


@query(
    "split_hash",
    """
    SELECT c_custkey, c_acctbal, CASE WHEN (((c_custkey % 1000003) * 7919) % 1000003) % 100 < 10 THEN 1 ELSE 0 END AS is_validation
    FROM customer
    """,
)
def split_hash(spark, folder):
    customer = Tables(spark, folder).customer.select("c_custkey", "c_acctbal")
    flagged = with_hold_out(customer, arithmetic_bucket("c_custkey"), 0.10)
    return flagged.withColumn("is_validation", F.col("is_validation").cast("int"))


@query(
    "split_ordered",
    """
    SELECT o_orderkey, o_totalprice,
           CASE WHEN row_number() OVER (ORDER BY o_orderkey) <= ceil(0.9 * (SELECT count(*) FROM orders)) THEN 0 ELSE 1 END AS is_validation
    FROM orders
    """,
)
def split_ordered(spark, folder):
    orders = Tables(spark, folder).orders.select("o_orderkey", "o_totalprice")
    return with_ordered_hold_out(orders, "o_orderkey").withColumn("is_validation", F.col("is_validation").cast("int"))




@query("scan_prefix", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem LIMIT 50000")
def file_prefix(spark, folder):
    """The first 50,000 lines as they lie in the file."""
    return scan_prefix(Tables(spark, folder).lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), 50_000)


MERGED = ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linenumber"]


def _merged_sql(c: str) -> str:
    number, text = (c, "NULL") if c != "l_returnflag" else ("NULL", c)
    return f"""SELECT '{c}' AS "column", count(*) AS n_rows, count({c}) AS n_present, count(DISTINCT {c}) AS n_distinct,
        CAST(min({number}) AS DOUBLE) AS low, CAST(max({number}) AS DOUBLE) AS high, CAST(min({text}) AS VARCHAR) AS low_text,
        CAST(max({text}) AS VARCHAR) AS high_text, {st(f"avg(CAST({number} AS DOUBLE))")} AS mean FROM lineitem"""


@query("profile_merged", " UNION ALL ".join(map(_merged_sql, MERGED)))
def profile_merged(spark, folder):
    """Profiles by line status, merged into that of all lines; few enough values for exact distinct counts."""
    parts = K.profile(Tables(spark, folder).lineitem, MERGED, by=["l_linestatus"])
    return stable_columns(K.read_profile(K.merge_profiles(parts)).drop("kind", "quantiles"), "mean")
