"""Group statistics and rollups through the hierarchy."""

from pyspark.sql import functions as F

from entityloom.catalog.base import Tables, all_stable, query, st, stable_columns
from entityloom.operators import rollup as R
from entityloom.operators import sparse as SP
from entityloom.operators.encode import fit_values

MEASURES = ["l_quantity", "l_extendedprice", "l_discount"]


def _parents(t):
    return t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")


@query(
    "group_mean",
    f"""
    SELECT o_custkey, {st("avg(o_orderkey)")} AS o_orderkey, {st("avg(o_totalprice)")} AS o_totalprice
    FROM orders GROUP BY o_custkey
    """,
)
def group_mean(spark, folder):
    return all_stable(R.group_means(Tables(spark, folder).orders, "o_custkey"))


@query(
    "group_count",
    """
    SELECT o_custkey, count(*) AS n_rows, count(nullif(o_orderpriority, '4-NOT SPECIFIED')) AS priority_count,
           count(o_totalprice) AS o_totalprice_count
    FROM orders GROUP BY o_custkey
    """,
)
def group_count(spark, folder):
    known = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED"))
    orders = Tables(spark, folder).orders.withColumn("priority", known)
    return R.group_stats(orders, "o_custkey", {"priority": ["count"], "o_totalprice": ["count"]}, "n_rows")


@query(
    "group_minmax",
    """
    SELECT o_custkey, min(o_totalprice) AS o_totalprice_min, max(o_totalprice) AS o_totalprice_max
    FROM orders GROUP BY o_custkey
    """,
)
def group_minmax(spark, folder):
    return R.group_stats(Tables(spark, folder).orders, "o_custkey", {"o_totalprice": ["min", "max"]})


@query(
    "group_sum",
    f"""
    SELECT l_orderkey, {st("sum(l_extendedprice)")} AS l_extendedprice_sum,
           {st("coalesce(sum(nullif(l_discount, 0)), 0)")} AS discount_sum
    FROM lineitem GROUP BY l_orderkey
    """,
)
def group_sum(spark, folder):
    lines = Tables(spark, folder).lineitem.withColumn("discount", F.nullif(F.col("l_discount"), F.lit(0.0)))
    return all_stable(R.group_stats(lines, "l_orderkey", {"l_extendedprice": ["sum"], "discount": ["sum"]}))


@query(
    "group_std",
    f"SELECT l_orderkey, {st('stddev_samp(l_extendedprice)')} AS l_extendedprice_std FROM lineitem GROUP BY l_orderkey",
)
def group_std(spark, folder):
    return all_stable(R.group_stats(Tables(spark, folder).lineitem, "l_orderkey", {"l_extendedprice": ["std"]}))


@query(
    "minmax_string",
    """
    SELECT o_custkey, count(*) AS n_rows, max(o_totalprice) AS o_totalprice_max,
           min(o_orderpriority) AS o_orderpriority_min, max(o_orderpriority) AS o_orderpriority_max
    FROM orders GROUP BY o_custkey
    """,
)
def minmax_string(spark, folder):
    stats = {"o_totalprice": ["max"], "o_orderpriority": ["min", "max"]}
    return R.group_stats(Tables(spark, folder).orders, "o_custkey", stats, "n_rows")


SQL_STATS = {"count": "count({})", "average": "avg({})", "min": "min({})", "max": "max({})", "sum": "sum({})"}


def _stats_sql(name, stats=R.ROLLUP_STATS):
    return ", ".join(f"{SQL_STATS[s].format(c)} AS {c}_{name}_{s}" for c in MEASURES for s in stats)


def _output_sql(name, stats=R.ROLLUP_STATS, wrap="{}"):
    return ", ".join(
        (st(wrap.format(n)) if s != "count" or wrap != "{}" else n) + f" AS {n}"
        for c in MEASURES
        for s in stats
        for n in [f"{c}_{name}_{s}"]
    )


@query(
    "rollup_general",
    f"""
    SELECT l_orderkey, o_custkey, n_rows, {_output_sql("line")}
    FROM (SELECT l_orderkey, count(*) AS n_rows, {_stats_sql("line")} FROM lineitem GROUP BY l_orderkey)
    JOIN orders ON o_orderkey = l_orderkey
    """,
)
def rollup_general(spark, folder):
    t = Tables(spark, folder)
    rolled = R.rollup_general(t.lineitem, "l_orderkey", "o_custkey", "line", MEASURES, parents=_parents(t))
    return all_stable(rolled)


@query(
    "rollup_general_orphans",
    f"""
    WITH lines AS (SELECT * REPLACE (nullif(l_orderkey, 2) AS l_orderkey) FROM lineitem)
    SELECT n.l_orderkey, o_custkey, n_rows, {_output_sql("line")}
    FROM (SELECT l_orderkey, count(*) AS n_rows FROM lines GROUP BY l_orderkey) n
    LEFT JOIN (SELECT l_orderkey, {_stats_sql("line")} FROM lines WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey) s
      ON s.l_orderkey = n.l_orderkey
    LEFT JOIN orders ON o_orderkey = n.l_orderkey
    """,
)
def rollup_general_orphans(spark, folder):
    """Lines without an order key, and all orders as parents."""
    t = Tables(spark, folder)
    lines = t.lineitem.withColumn("l_orderkey", F.nullif("l_orderkey", F.lit(2)))
    return all_stable(R.rollup_general(lines, "l_orderkey", "o_custkey", "line", MEASURES, parents=_parents(t)))


# lines of one order without a key, those of some others with a key that no order has
LINE_OWNER = "CASE WHEN l_orderkey < 100 THEN -nullif(l_orderkey, 2) ELSE l_orderkey END"


@query(
    "rollup_general_unknown",
    f"""
    WITH lines AS (SELECT * REPLACE ({LINE_OWNER} AS l_orderkey) FROM lineitem)
    SELECT n.l_orderkey, o_custkey, n_rows, {_output_sql("line")}
    FROM (SELECT l_orderkey, count(*) AS n_rows FROM lines GROUP BY l_orderkey) n
    LEFT JOIN (SELECT l_orderkey, {_stats_sql("line")} FROM lines WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey) s
      ON s.l_orderkey = n.l_orderkey
    LEFT JOIN orders ON o_orderkey = n.l_orderkey
    """,
)
def rollup_general_unknown(spark, folder):
    """Lines without an order key and of unknown orders, and all orders as parents."""
    t = Tables(spark, folder)
    lines = t.lineitem.withColumn("l_orderkey", F.expr(LINE_OWNER))
    return all_stable(R.rollup_general(lines, "l_orderkey", "o_custkey", "line", MEASURES, parents=_parents(t)))


@query(
    "rollup_general_shared",
    f"""
    SELECT l_partkey, l_suppkey, n_rows, {_output_sql("part")}
    FROM (SELECT l_partkey, l_suppkey, count(*) AS n_rows FROM lineitem GROUP BY ALL)
    JOIN (SELECT l_partkey, {_stats_sql("part")} FROM lineitem GROUP BY l_partkey) USING (l_partkey)
    """,
)
def rollup_general_shared(spark, folder):
    return all_stable(R.rollup_general(Tables(spark, folder).lineitem, "l_partkey", "l_suppkey", "part", MEASURES))


FOUR = R.ROLLUP_STATS[:4]


@query(
    "rollup_two_level",
    f"""
    WITH per_order AS (SELECT l_orderkey, {_stats_sql("line", FOUR)} FROM lineitem GROUP BY l_orderkey)
    SELECT o_custkey, {_output_sql("line", FOUR, "avg({})")}
    FROM lineitem JOIN per_order USING (l_orderkey) JOIN orders ON o_orderkey = l_orderkey GROUP BY o_custkey
    """,
)
def rollup_two_level(spark, folder):
    t = Tables(spark, folder)
    rolled = R.rollup_two_level(t.lineitem, "l_orderkey", "o_custkey", "line", MEASURES, parents=_parents(t))
    return all_stable(rolled)


@query(
    "rollup_two_level_shared",
    f"""
    WITH per_part AS (SELECT l_partkey, {_stats_sql("part", FOUR)} FROM lineitem GROUP BY l_partkey)
    SELECT l_suppkey, {_output_sql("part", FOUR, "avg({})")}
    FROM lineitem JOIN per_part USING (l_partkey) GROUP BY l_suppkey
    """,
)
def rollup_two_level_shared(spark, folder):
    return all_stable(R.rollup_two_level(Tables(spark, folder).lineitem, "l_partkey", "l_suppkey", "part", MEASURES))


@query(
    "rollup_hierarchy",
    f"""
    WITH lines AS (SELECT l_orderkey, avg(l_quantity) AS quantity, avg(l_extendedprice) AS price FROM lineitem GROUP BY l_orderkey)
    SELECT o_custkey, {st("avg(o_totalprice)")} AS o_totalprice, {st("avg(quantity)")} AS quantity, {st("avg(price)")} AS price
    FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey GROUP BY o_custkey
    """,
)
def rollup_hierarchy(spark, folder):
    t = Tables(spark, folder)
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price")
    )
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return all_stable(R.rollup_hierarchy(orders, lines, "o_orderkey", "o_custkey").drop("o_orderkey"))


@query(
    "aggregate_back",
    f"""
    SELECT l_orderkey, l_linenumber, l_extendedprice, count(*) OVER w AS line_count,
           {st("avg(l_extendedprice) OVER w")} AS l_extendedprice_mean, max(l_extendedprice) OVER w AS l_extendedprice_max,
           min(l_extendedprice) OVER w AS l_extendedprice_min
    FROM lineitem WINDOW w AS (PARTITION BY l_orderkey)
    """,
)
def aggregate_back(spark, folder):
    lines = Tables(spark, folder).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    backed = R.aggregate_back(lines, "l_orderkey", {"l_extendedprice": ["mean", "max", "min"]}, "line_count")
    return stable_columns(backed, "l_extendedprice_mean")


@query(
    "feature_block",
    f"""
    SELECT o_custkey, count(*) AS order_rows, {st("avg(o_totalprice)")} AS o_totalprice,
           min(o_totalprice) AS o_totalprice_min, max(o_totalprice) AS o_totalprice_max
    FROM orders GROUP BY o_custkey
    """,
)
def feature_block(spark, folder):
    orders = Tables(spark, folder).orders
    return stable_columns(R.feature_block(orders, "o_custkey", "order_rows", ["o_totalprice"]), "o_totalprice")


@query(
    "feature_block_zero",
    f"""
    WITH o AS (SELECT o_custkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS paid FROM orders)
    SELECT o_custkey, count(*) AS order_rows, {st("avg(coalesce(paid, 0))")} AS paid,
           {st("coalesce(avg(paid), 0)")} AS paid_mean, coalesce(min(paid), 0) AS paid_min, coalesce(max(paid), 0) AS paid_max
    FROM o GROUP BY o_custkey
    """,
)
def feature_block_zero(spark, folder):
    paid = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("paid")
    orders = Tables(spark, folder).orders.select("o_custkey", paid)
    return stable_columns(R.feature_block(orders, "o_custkey", "order_rows", after="zero"), "paid", "paid_mean")


@query(
    "category_share",
    f"""
    SELECT o_custkey, count(*) AS feature_app_count,
           {st("avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)")} AS feature_o_orderstatus_F_mean,
           {st("avg(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END)")} AS feature_o_orderstatus_O_mean,
           {st("avg(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END)")} AS feature_o_orderstatus_P_mean,
           {st("avg(o_totalprice)")} AS o_totalprice_mean
    FROM orders GROUP BY o_custkey
    """,
)
def category_share(spark, folder):
    orders = Tables(spark, folder).orders
    values = fit_values(orders, ["o_orderstatus"])
    return all_stable(R.category_share(orders, "o_custkey", values, ["o_totalprice"]))


@query(
    "category_share_long",
    f"""
    WITH cells AS (SELECT o_custkey, 'o_orderstatus' AS "column", o_orderstatus AS value FROM orders
                   UNION ALL SELECT o_custkey, 'o_orderpriority', coalesce(nullif(o_orderpriority, '1-URGENT'), '') FROM orders)
    SELECT o_custkey, "column", value, count(*) AS n_rows, {st("count(*) / any_value(n)")} AS share
    FROM cells JOIN (SELECT o_custkey, count(*)::DOUBLE AS n FROM orders GROUP BY o_custkey) USING (o_custkey)
    GROUP BY o_custkey, "column", value
    """,
)
def category_share_long(spark, folder):
    orders = Tables(spark, folder).orders.withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("1-URGENT")))
    return all_stable(R.category_share_long(orders, "o_custkey", ["o_orderstatus", "o_orderpriority"]))


@query(
    "reduce_to_key",
    f"""
    WITH m AS (SELECT o_custkey, avg(o_orderkey) AS o_orderkey_int_mean, avg(o_totalprice) AS price FROM orders GROUP BY o_custkey)
    SELECT DISTINCT o_custkey, o_orderstatus, {st("o_orderkey_int_mean")} AS o_orderkey_int_mean, {st("price")} AS o_totalprice
    FROM orders JOIN m USING (o_custkey)
    """,
)
def reduce_to_key(spark, folder):
    orders = Tables(spark, folder).orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    return all_stable(R.reduce_to_key(orders, "o_custkey", ["o_custkey", "o_totalprice"], carry=["o_orderstatus"]))


@query(
    "sparse_share",
    f"""
    WITH cells AS (
      SELECT l_suppkey, 'l_partkey' AS c, coalesce(CAST(l_partkey AS VARCHAR), '') AS v FROM lineitem
      UNION ALL SELECT l_suppkey, 'l_returnflag', coalesce(l_returnflag, '') FROM lineitem),
    slots AS (SELECT c, v, CAST(row_number() OVER (ORDER BY c, v) - 1 AS INTEGER) AS slot FROM (SELECT DISTINCT c, v FROM cells)),
    sizes AS (SELECT l_suppkey, count(*) AS n_rows FROM lineitem GROUP BY l_suppkey)
    SELECT l_suppkey, any_value(n_rows) AS n_rows, slot, {st("count(*) / any_value(n_rows)")} AS share
    FROM cells JOIN slots USING (c, v) JOIN sizes USING (l_suppkey) WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey, slot
    """,
)
def sparse_share(spark, folder):
    """Shares of every part and return flag among a supplier's lines, as slots of a sparse vector."""
    lines = Tables(spark, folder).lineitem.select("l_suppkey", "l_partkey", "l_returnflag")
    slots = SP.fit_slots(lines, columns=["l_partkey", "l_returnflag"])
    vectors = SP.sparse_shares(lines, "l_suppkey", slots)
    long = vectors.select("l_suppkey", "n_rows", F.explode(F.arrays_zip("indices", "shares")).alias("s"))
    return stable_columns(long.select("l_suppkey", "n_rows", F.col("s.indices").alias("slot"), F.col("s.shares").alias("share")), "share")
