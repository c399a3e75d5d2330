"""Joins."""

from pyspark.sql import functions as F

from entityloom.catalog.base import Tables, all_stable, query, st, stable_columns
from entityloom.operators import factors as X
from entityloom.operators import joins as J
from entityloom.operators.columns import shared_columns
from entityloom.operators.rollup import group_stats

PER_ORDER = "SELECT l_orderkey, count(*) AS n_lines, sum(l_extendedprice) AS price FROM lineitem GROUP BY l_orderkey"


def _per_order(t):
    sums = group_stats(t.lineitem, "l_orderkey", {"l_extendedprice": ["sum"]}, "n_lines")
    return sums.select(F.col("l_orderkey").alias("o_orderkey"), "n_lines", F.col("l_extendedprice_sum").alias("price"))


@query(
    "join_left",
    f"""
    SELECT c_custkey, c_mktsegment, n_events, {st("mean_value")} AS mean_value FROM customer
    LEFT JOIN (SELECT user_id, count(*) AS n_events, avg(value) AS mean_value FROM events GROUP BY user_id)
    ON user_id = c_custkey
    """,
)
def join_left(spark, folder):
    t = Tables(spark, folder)
    stats = group_stats(t.events.withColumnRenamed("user_id", "c_custkey"), "c_custkey", {"value": ["mean"]}, "n_events")
    joined = t.customer.select("c_custkey", "c_mktsegment").join(stats, "c_custkey", "left")
    return all_stable(joined.withColumnRenamed("value_mean", "mean_value"))


@query(
    "join_inner",
    f"""
    SELECT o_orderkey, o_totalprice, n_lines, {st("price")} AS price
    FROM orders JOIN ({PER_ORDER}) ON l_orderkey = o_orderkey
    """,
)
def join_inner(spark, folder):
    t = Tables(spark, folder)
    return stable_columns(t.orders.select("o_orderkey", "o_totalprice").join(_per_order(t), "o_orderkey"), "price")


@query(
    "join_full",
    f"""
    SELECT coalesce(o_orderkey, l_orderkey) AS o_orderkey, o_custkey, n_lines, {st("price")} AS price
    FROM (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'F')
    FULL JOIN ({PER_ORDER}) ON l_orderkey = o_orderkey
    """,
)
def join_full(spark, folder):
    t = Tables(spark, folder)
    still_open = t.orders.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_custkey")
    return all_stable(J.natural_join(still_open, _per_order(t), "full"))


@query(
    "join_two_keys",
    f"""
    SELECT l_partkey, l_suppkey, a.quantity AS quantity_billed, b.quantity AS quantity_open
    FROM (SELECT l_partkey, l_suppkey, sum(l_quantity) AS quantity FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL) a
    JOIN (SELECT l_partkey, l_suppkey, sum(l_quantity) AS quantity FROM lineitem WHERE l_linestatus = 'O' GROUP BY ALL) b
    USING (l_partkey, l_suppkey)
    """,
)
def join_two_keys(spark, folder):
    lines = Tables(spark, folder).lineitem
    keys = ["l_partkey", "l_suppkey"]

    def total(status):
        return lines.filter(F.col("l_linestatus") == status).groupBy(*keys).agg(F.sum("l_quantity").alias("quantity"))

    return J.join_with_suffixes(total("F"), total("O"), keys, ("_billed", "_open"))


PER_CUSTOMER = "SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey"
PER_STATUS = "SELECT o_custkey, o_orderstatus, count(*) AS n_status FROM orders GROUP BY o_custkey, o_orderstatus"


def _per_status(t):
    return group_stats(t.orders, ["o_custkey", "o_orderstatus"], {}, "n_status")


@query("join_natural", f"SELECT * FROM ({PER_STATUS}) NATURAL JOIN ({PER_CUSTOMER})")
def join_natural(spark, folder):
    t = Tables(spark, folder)
    return J.natural_join(_per_status(t), group_stats(t.orders, "o_custkey", {}, "n_orders"))


@query(
    "join_natural_left",
    """
    SELECT o_custkey, o_orderstatus, n_status, n_urgent FROM
    (SELECT o_custkey, o_orderstatus, count(*) AS n_status FROM orders GROUP BY ALL) NATURAL LEFT JOIN
    (SELECT o_custkey, o_orderstatus, count(*) AS n_urgent FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY ALL)
    """,
)
def join_natural_left(spark, folder):
    t = Tables(spark, folder)
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'")
    return J.natural_join(_per_status(t), group_stats(urgent, ["o_custkey", "o_orderstatus"], {}, "n_urgent"), "left")


@query(
    "join_null_safe",
    """
    WITH o AS (SELECT nullif(o_orderstatus, 'P') AS status, nullif(o_orderpriority, '5-LOW') AS priority FROM orders)
    SELECT a.status AS status, a.priority AS priority, n_pair, n_status
    FROM (SELECT status, priority, count(*) AS n_pair FROM o GROUP BY ALL) a
    JOIN (SELECT status, count(*) AS n_status FROM o GROUP BY ALL) b ON a.status IS NOT DISTINCT FROM b.status
    """,
)
def join_null_safe(spark, folder):
    orders = Tables(spark, folder).orders.select(
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
    )
    pairs = orders.groupBy("status", "priority").agg(F.count(F.lit(1)).alias("n_pair"))
    return J.join_null_safe(pairs, orders.groupBy("status").agg(F.count(F.lit(1)).alias("n_status")), ["status"])


@query(
    "join_fold_outer",
    f"""
    WITH a AS (SELECT o_custkey AS k, 1 AS g_column, count(*) AS n_done FROM orders WHERE o_orderstatus = 'F' GROUP BY k),
    b AS (SELECT user_id AS k, 1 AS g_column, count(*) AS n_events, max(value) AS max_value FROM events GROUP BY k),
    c AS (SELECT o_custkey AS k, 1 AS g_column, sum(l_quantity) AS quantity
          FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY k)
    SELECT k, g_column, n_done, n_events, max_value, quantity
    FROM a FULL JOIN b USING (k, g_column) FULL JOIN c USING (k, g_column)
    """,
)
def join_fold_outer(spark, folder):
    t = Tables(spark, folder)
    one = F.lit(1).alias("g_column")
    done = t.orders.filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("k")).agg(
        F.count(F.lit(1)).alias("n_done")
    )
    seen = t.events.groupBy(F.col("user_id").alias("k")).agg(
        F.count(F.lit(1)).alias("n_events"), F.max("value").alias("max_value")
    )
    # lines are summed per order before they meet the orders
    per_order = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("quantity"))
    bought = (
        t.orders.select("o_orderkey", F.col("o_custkey").alias("k"))
        .join(per_order, "o_orderkey")
        .groupBy("k")
        .agg(F.sum("quantity").alias("quantity"))
    )
    blocks = [b.select("*", one) for b in (done, seen, bought)]
    return J.fold_outer(blocks, shared_columns(*blocks))


@query(
    "join_suffix",
    """
    SELECT k, a.n AS n, a.total AS total, b.n AS n_events, b.total AS total_events
    FROM (SELECT o_custkey AS k, count(*) AS n, max(o_totalprice) AS total FROM orders GROUP BY k) a
    LEFT JOIN (SELECT user_id AS k, count(*) AS n, max(value) AS total FROM events GROUP BY k) b USING (k)
    """,
)
def join_suffix(spark, folder):
    t = Tables(spark, folder)

    def block(df, key, value):
        return df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"), F.max(value).alias("total"))

    left, right = block(t.orders, "o_custkey", "o_totalprice"), block(t.events, "user_id", "value")
    return J.join_with_suffixes(left, right, ["k"], ("", "_events"), "left")


@query(
    "join_labels",
    "SELECT doc_id, lang, source, n_chars, length(text) AS text_length, quality, toxic FROM documents JOIN labels USING (doc_id)",
)
def join_labels(spark, folder):
    t = Tables(spark, folder)
    documents = t.documents.select("doc_id", "lang", "source", "n_chars", F.length("text").cast("long").alias("text_length"))
    return documents.join(t.labels, "doc_id")


@query(
    "join_many_to_many",
    f"""
    SELECT o_custkey AS k, CAST(count(*) AS DOUBLE) AS chain_rows, {st("sum(o_totalprice)")} AS chain_sum_o_totalprice,
           {st("sum(l_quantity)")} AS chain_sum_l_quantity, {st("sum(value)")} AS chain_sum_value
    FROM orders
    JOIN (SELECT o_custkey AS line_custkey, l_quantity FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
      ON line_custkey = o_custkey
    JOIN events ON user_id = o_custkey
    GROUP BY o_custkey
    """,
)
def join_many_to_many(spark, folder):
    t = Tables(spark, folder)
    orders = t.orders.withColumnRenamed("o_custkey", "k")
    # lines are counted and summed per order, then per customer
    per_order = J.chain_block(t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "n", ["l_quantity"])
    lines = (
        orders.select("o_orderkey", "k")
        .join(per_order, "o_orderkey")
        .groupBy("k")
        .agg(F.sum("n").alias("n_lines"), F.sum("l_quantity").alias("l_quantity"))
    )
    chain = [
        (J.chain_block(orders, "k", "n_orders", ["o_totalprice"]), "n_orders"),
        (lines, "n_lines"),
        (J.chain_block(t.events.withColumnRenamed("user_id", "k"), "k", "n_events", ["value"]), "n_events"),
    ]
    sums = ["chain_sum_o_totalprice", "chain_sum_l_quantity", "chain_sum_value"]
    return stable_columns(J.chain_totals(chain, "k"), *sums)


def _chain_sql(columns: list[str], pairs: list[tuple[str, str]]) -> str:
    out = []
    for c in columns:
        out += [f"CAST(count({c}) AS DOUBLE) AS {c}_count", f"{st(f'sum({c})')} AS {c}_sum", f"{st(f'avg({c})')} AS {c}_mean"]
        out += [f"{st(f'stddev_samp({c})')} AS {c}_std", f"CAST(min({c}) AS DOUBLE) AS {c}_min", f"CAST(max({c}) AS DOUBLE) AS {c}_max"]
    for a, b in pairs:
        out += [f"{st(f'avg(CAST({a} AS DOUBLE) * {b})')} AS {a}_{b}_product_mean", f"{st(f'covar_samp({a}, {b})')} AS {a}_{b}_covariance"]
    return ", ".join(out)


_CHAIN_COLUMNS = ["c_acctbal", "o_totalprice", "l_quantity", "l_extendedprice", "value"]
_CHAIN_PAIRS = [("c_acctbal", "o_totalprice"), ("l_quantity", "l_extendedprice"), ("c_acctbal", "value")]


@query(
    "join_chain_statistics",
    f"""
    SELECT c_nationkey, CAST(count(*) AS DOUBLE) AS n_rows, {_chain_sql(_CHAIN_COLUMNS, _CHAIN_PAIRS)}
    FROM customer
    JOIN orders ON o_custkey = c_custkey
    JOIN (SELECT o_custkey AS line_custkey, l_quantity, l_extendedprice FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
      ON line_custkey = c_custkey
    JOIN events ON user_id = c_custkey
    GROUP BY c_nationkey
    """,
)
def join_chain_statistics(spark, folder):
    """Customers x their orders x their lines x their events by nation, from sums per customer."""
    t = Tables(spark, folder)
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    events = t.events.withColumnRenamed("user_id", "c_custkey")
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    measured = [["c_acctbal"], ["o_totalprice"], ["l_quantity", "l_extendedprice"], ["value"]]
    centres = {}
    for df, columns in zip((t.customer, orders, lines, events), measured):
        centres |= X.column_centres(df, columns)
    per_order = X.factor(lines, ["o_orderkey"], measured[2], [("l_quantity", "l_extendedprice")], centres)
    owners = X.factor(orders, ["o_orderkey", "c_custkey"])
    chain = [
        X.factor(t.customer, ["c_nationkey", "c_custkey"], measured[0], centres=centres),
        X.factor(orders, ["c_custkey"], measured[1], centres=centres),
        X.marginal(X.multiply(owners, per_order), ["c_custkey"]),
        X.factor(events, ["c_custkey"], measured[3], centres=centres),
    ]
    whole = X.multiply_all(chain, [("c_acctbal", "o_totalprice"), ("c_acctbal", "value")])
    out = X.statistics(X.marginal(whole, ["c_nationkey"]))
    return stable_columns(out, *[c for c in out.columns if c.endswith(("_sum", "_mean", "_std", "_covariance"))])
