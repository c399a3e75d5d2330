"""Categorical encoding."""

from pyspark.sql import functions as F

from entityloom.catalog.base import Tables, query
from entityloom.operators import encode as E

# The order priorities in the driver's tables, as column name parts.
PRIORITIES = {"1-URGENT": "1_URGENT", "2-HIGH": "2_HIGH", "3-MEDIUM": "3_MEDIUM", "5-LOW": "5_LOW"}


def _flags(condition="priority = '{}'"):
    return ", ".join(
        f"CASE WHEN {condition.format(v)} THEN 1 ELSE 0 END AS feature_priority_{n}" for v, n in PRIORITIES.items()
    )


SOURCE = "SELECT o_orderkey, o_totalprice, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority FROM orders"


def _orders(spark, folder):
    priority = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("priority")
    return Tables(spark, folder).orders.select("o_orderkey", "o_totalprice", priority)


@query(
    "onehot_keep_null",
    f"""
    SELECT o_orderkey, o_totalprice, {_flags()}, CASE WHEN priority IS NULL THEN 1 ELSE 0 END AS feature_priority_nan
    FROM ({SOURCE})
    """,
)
def onehot_keep_null(spark, folder):
    orders = _orders(spark, folder)
    return E.one_hot(orders, E.fit_values(orders), protect=["o_orderkey"])


@query("drop_strings", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def drop_strings(spark, folder):
    return E.drop_text(Tables(spark, folder).orders.drop("o_orderdate"), protect=["o_orderkey"])


@query(
    "indicator_append",
    f"""
    SELECT o_orderkey, o_totalprice, coalesce(priority, '') AS priority, {_flags()},
           CASE WHEN priority IS NULL THEN 1 ELSE 0 END AS feature_priority_
    FROM ({SOURCE})
    """,
)
def indicator_append(spark, folder):
    orders = _orders(spark, folder)
    return E.append_indicators(orders, E.fit_values(orders), protect=["o_orderkey"])


@query(
    "label_encode",
    """
    SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS INTEGER) AS o_orderstatus,
           CAST(dense_rank() OVER (ORDER BY coalesce(nullif(o_orderpriority, '4-NOT SPECIFIED'), 'nan')) - 1 AS INTEGER) AS priority
    FROM orders
    """,
)
def label_encode(spark, folder):
    priority = F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("priority")
    orders = Tables(spark, folder).orders.select("o_orderkey", "o_orderstatus", priority)
    return E.label_encode(orders, protect=["o_orderkey"], missing="nan")


@query(
    "label_encode_many",
    """
    SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS INTEGER) AS c_name FROM customer
    """,
)
def label_encode_many(spark, folder):
    customer = Tables(spark, folder).customer.select("c_custkey", "c_name")
    return E.label_encode(customer, protect=["c_custkey"])


@query(
    "label_encode_shared",
    """
    WITH codes AS (
      SELECT c_mktsegment AS value, CAST(row_number() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS code FROM
      (SELECT DISTINCT c_mktsegment FROM customer))
    SELECT c_custkey, 'train' AS part, code AS c_mktsegment FROM customer JOIN codes ON value = c_mktsegment WHERE c_acctbal >= 0
    UNION ALL
    SELECT c_custkey, 'test' AS part, code AS c_mktsegment FROM customer JOIN codes ON value = c_mktsegment WHERE c_acctbal < 0
    """,
)
def label_encode_shared(spark, folder):
    customer = Tables(spark, folder).customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    train = customer.filter("c_acctbal >= 0").drop("c_acctbal")
    test = customer.filter("c_acctbal < 0").drop("c_acctbal")
    codes = E.fit_codes(train, test)
    parts = [codes.transform(df).withColumn("part", F.lit(n)) for n, df in (("train", train), ("test", test))]
    return parts[0].unionByName(parts[1])


@query(
    "label_codes",
    """
    SELECT 'event_type' AS "column", event_type AS value, CAST(row_number() OVER (ORDER BY event_type) - 1 AS INTEGER) AS code
    FROM (SELECT DISTINCT event_type FROM events)
    UNION ALL
    SELECT 'props' AS "column", props AS value, CAST(row_number() OVER (ORDER BY props) - 1 AS INTEGER) AS code
    FROM (SELECT DISTINCT props FROM events)
    """,
)
def label_codes(spark, folder):
    return E.codes_table(E.fit_codes(Tables(spark, folder).events.select("event_type", "props")))
