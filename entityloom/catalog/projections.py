"""Projections, unions, membership."""

from pyspark.sql import functions as F

from entityloom.catalog.base import Tables, query
from entityloom.functions.scalars import as_number, as_text, flag_not_equal
from entityloom.operators import columns as C
from entityloom.operators.clean import drop_missing
from entityloom.operators.joins import in_keys, union_all_columns, untag, union_tagged
from entityloom.operators.profile import shape
from entityloom.operators.rollup import distinct_count, distinct_values, group_stats


@query("scan_project", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def scan_project(spark, folder):
    orders = C.keep(Tables(spark, folder).orders, ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    return C.drop_present(orders, ["o_orderdate", "no_such_column"])


@query(
    "union_missing_label",
    """
    SELECT c_custkey, c_nationkey, c_acctbal, 'train' AS part,
           CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS target
    FROM customer WHERE c_custkey % 5 <> 0
    UNION ALL BY NAME
    SELECT c_custkey, c_nationkey, c_acctbal, 'test' AS part FROM customer WHERE c_custkey % 5 = 0
    """,
)
def union_missing_label(spark, folder):
    customer = Tables(spark, folder).customer.select("c_custkey", "c_nationkey", "c_acctbal")
    in_test = F.pmod(F.col("c_custkey"), F.lit(5)) == 0
    train = customer.filter(~in_test).withColumn("target", F.when(F.col("c_acctbal") < 0, 1).otherwise(0))
    both = union_tagged("part", train=train, test=customer.filter(in_test))
    # apart and together again: nothing may get lost on the way
    parts = [untag(both, "part", p).withColumn("part", F.lit(p)) for p in ("train", "test")]
    return union_all_columns(*parts)


@query(
    "semi_split",
    """
    SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
    WHERE EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)
    """,
)
def semi_split(spark, folder):
    t = Tables(spark, folder)
    ids = t.events.select(F.col("user_id").alias("c_custkey"))
    return in_keys(t.customer.select("c_custkey", "c_mktsegment", "c_acctbal"), ids, "c_custkey")


@query(
    "drop_missing_key",
    """
    SELECT c_custkey, user_id, n_events FROM customer
    LEFT JOIN (SELECT user_id, count(*) AS n_events FROM events GROUP BY user_id) ON user_id = c_custkey
    WHERE user_id IS NOT NULL
    """,
)
def drop_missing_key(spark, folder):
    t = Tables(spark, folder)
    counts = group_stats(t.events, "user_id", {}, "n_events")
    joined = t.customer.join(counts, F.col("c_custkey") == F.col("user_id"), "left")
    return drop_missing(joined, ["user_id"]).select("c_custkey", "user_id", "n_events")


@query(
    "flag_not_equal",
    "SELECT o_orderkey, CASE WHEN nullif(o_orderstatus, 'P') IS DISTINCT FROM 'F' THEN 1 ELSE 0 END AS still_open FROM orders",
)
def flag_query(spark, folder):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return Tables(spark, folder).orders.select("o_orderkey", flag_not_equal(status, "F").alias("still_open"))


@query(
    "constant_rename",
    """
    SELECT o_orderkey, o_custkey, o_totalprice AS o_totalprice_mean, o_orderstatus AS o_orderstatus_mean, 1 AS g_column
    FROM orders
    """,
)
def constant_rename(spark, folder):
    orders = Tables(spark, folder).orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    return C.add_suffix(C.add_constant(orders, "g_column"), "_mean", ["o_orderkey", "o_custkey", "g_column"])


@query("drop_by_pattern", "SELECT l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def drop_by_pattern(spark, folder):
    without = C.drop_containing(Tables(spark, folder).lineitem, ["key", "no_such_part"])
    return C.only_numeric(C.drop_present(without, ["no_such_column"]))


@query(
    "cast_text",
    """
    SELECT p_partkey, coalesce(CAST(nullif(p_size, 1) AS VARCHAR), 'nan') AS size_text,
           TRY_CAST(right(p_brand, 2) AS DOUBLE) AS brand_number, TRY_CAST(p_brand AS DOUBLE) AS no_number
    FROM part
    """,
)
def cast_text(spark, folder):
    return Tables(spark, folder).part.select(
        "p_partkey",
        as_text(F.nullif(F.col("p_size"), F.lit(1))).alias("size_text"),
        as_number(F.right("p_brand", F.lit(2))).alias("brand_number"),
        as_number(F.col("p_brand")).alias("no_number"),
    )


@query("distinct_rows", "SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark, folder):
    return Tables(spark, folder).lineitem.select("l_orderkey", "l_returnflag", "l_linestatus").dropDuplicates()


@query("distinct_values", "SELECT DISTINCT o_orderpriority FROM orders")
def distinct_query(spark, folder):
    return distinct_values(Tables(spark, folder).orders, "o_orderpriority")


@query("distinct_count", "SELECT count(DISTINCT o_custkey) AS o_custkey FROM orders")
def distinct_count_query(spark, folder):
    return distinct_count(Tables(spark, folder).orders, "o_custkey")


@query("table_shape", "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def table_shape(spark, folder):
    return shape(Tables(spark, folder).lineitem)
