"""Wide tables and replayed specs: whole feature plans on the driver's tables."""

from pyspark.sql import functions as F

from entityloom.catalog.base import Tables, all_stable, query, st, stable_columns
from entityloom.functions.scalars import flag_not_equal
from entityloom.operators.clean import clean, fill_number
from entityloom.operators.columns import append
from entityloom.operators.encode import fit_values, one_hot
from entityloom.operators.rollup import feature_block, rollup_two_level
from entityloom.operators.skew import attach_by_key
from entityloom.plans.assemble import assemble, attach_blocks
from entityloom.plans.replay import FeatureSpec, apply_specs, replay_block, replay_tables
from entityloom.sources.specs import spec_table, specs_of
from entityloom.sources.stages import Stages

STATS = ("count", "average", "min", "max")
LINE_SPECS = (
    FeatureSpec("price_over_quantity", "ratio_ieee", ("l_extendedprice", "l_quantity")),
    FeatureSpec("quantity_over_discount", "ratio_ieee", ("l_quantity", "l_discount")),
)
LINE_COLUMNS = ["l_extendedprice", "price_over_quantity", "quantity_over_discount"]
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
WIDE_SPECS = (
    FeatureSpec("o_totalprice_over_c_acctbal", "ratio_clamped", ("o_totalprice", "c_acctbal")),
    FeatureSpec("price_max_over_price", "ratio_clamped", ("o_totalprice_max", "o_totalprice")),
    FeatureSpec("value_minus_value_min", "diff", ("value", "value_min")),
    FeatureSpec("events_per_order", "ratio_clamped", ("event_rows", "order_rows")),
)

LINE_NAMES = [f"{c}_line_{s}" for c in LINE_COLUMNS for s in STATS]
SQL_STATS = {"count": "count({})", "average": "avg({})", "min": "min({})", "max": "max({})"}
EVENT_NAMES = [f"feature_event_type_{e}_mean" for e in EVENT_TYPES]
WIDE_NAMES = [
    "c_acctbal", "order_rows", "o_totalprice", "o_totalprice_min", "o_totalprice_max", "still_open", *LINE_NAMES,
    "event_rows", "value", "value_min", "value_max", *EVENT_NAMES,
]

LINES_SQL = f"""
    SELECT o_custkey AS c_custkey, {", ".join(f"avg({n}) AS {n}" for n in LINE_NAMES)}
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    JOIN (SELECT l_orderkey, {", ".join(SQL_STATS[s].format(c) + f" AS {c}_line_{s}" for c in LINE_COLUMNS for s in STATS)}
          FROM (SELECT l_orderkey, l_extendedprice, l_extendedprice / l_quantity AS price_over_quantity,
                       CASE WHEN l_discount <> 0 THEN l_quantity / l_discount END AS quantity_over_discount FROM lineitem)
          GROUP BY l_orderkey) USING (l_orderkey)
    GROUP BY o_custkey
    """


def _owner(t):
    return t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))


def _line_block(t):
    lines = clean(apply_specs(t.lineitem, LINE_SPECS), texts=(), numbers=(), text_fill=None, impute=None)
    return rollup_two_level(lines, "l_orderkey", "c_custkey", "line", LINE_COLUMNS, STATS, parents=_owner(t))


def customer_table(spark, folder):
    """Customers with their label and what their orders, lines and events tell about them."""
    t = Tables(spark, folder)
    label = F.when(F.col("c_acctbal") < 0, 1).otherwise(0)
    base = append(t.customer.select("c_custkey", "c_acctbal"), target=label)
    orders = t.orders.select(
        F.col("o_custkey").alias("c_custkey"), "o_totalprice", flag_not_equal(F.col("o_orderstatus"), "F").alias("open")
    )
    order_block = feature_block(orders, "c_custkey", "order_rows", ["o_totalprice"], only_means=["open"])
    events = t.events.withColumnRenamed("user_id", "c_custkey")
    blocks = {
        "orders": order_block.withColumnRenamed("open", "still_open"),
        "lines": _line_block(t),
        "events": feature_block(events, "c_custkey", "event_rows", ["value"], shares={"event_type": EVENT_TYPES}),
    }
    wide = assemble(base, blocks, "c_custkey", ["target"])
    return apply_specs(wide, WIDE_SPECS)


@query(
    "assemble_wide",
    f"""
    WITH o AS (
      SELECT o_custkey AS c_custkey, count(*) AS order_rows, avg(o_totalprice) AS o_totalprice,
             min(o_totalprice) AS o_totalprice_min, max(o_totalprice) AS o_totalprice_max,
             avg(CASE WHEN o_orderstatus <> 'F' THEN 1 ELSE 0 END) AS still_open FROM orders GROUP BY o_custkey),
    l AS ({LINES_SQL}),
    e AS (
      SELECT user_id AS c_custkey, count(*) AS event_rows, avg(value) AS value, min(value) AS value_min,
             max(value) AS value_max,
             {", ".join(f"avg(CASE WHEN event_type = '{e}' THEN 1 ELSE 0 END) AS {n}" for e, n in zip(EVENT_TYPES, EVENT_NAMES))}
      FROM events GROUP BY user_id),
    joined AS (
      SELECT *, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS target FROM customer
      LEFT JOIN o USING (c_custkey) LEFT JOIN l USING (c_custkey) LEFT JOIN e USING (c_custkey)),
    filled AS (
      SELECT c_custkey, target, {", ".join(f"coalesce({n}, avg({n}) OVER ()) AS {n}" for n in WIDE_NAMES)}
      FROM (SELECT * REPLACE ({", ".join(f"CASE WHEN {n} <> 365243 THEN {n} END AS {n}" for n in WIDE_NAMES)}) FROM joined))
    SELECT c_custkey, target, {", ".join(f"{st(n)} AS {n}" for n in WIDE_NAMES)},
      {st("o_totalprice / greatest(1.0::DOUBLE, c_acctbal)")} AS o_totalprice_over_c_acctbal,
      {st("o_totalprice_max / greatest(1.0::DOUBLE, o_totalprice)")} AS price_max_over_price,
      {st("value - value_min")} AS value_minus_value_min,
      {st("event_rows / greatest(1.0::DOUBLE, order_rows)")} AS events_per_order
    FROM filled
    """,
)
def assemble_wide(spark, folder):
    return all_stable(customer_table(spark, folder))


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query(
    "assemble_two_level",
    f"""
    WITH l AS ({LINES_SQL})
    SELECT c_custkey, c_acctbal,
      {", ".join(f"CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END AS feature_c_mktsegment_{s}" for s in SEGMENTS)},
      CASE WHEN c_mktsegment IS NULL THEN 1 ELSE 0 END AS feature_c_mktsegment_nan,
      {", ".join(f"{st(f'coalesce({n}, 0)')} AS {n}" for n in LINE_NAMES)}
    FROM customer LEFT JOIN l USING (c_custkey)
    """,
)
def assemble_two_level(spark, folder):
    t = Tables(spark, folder)
    base = t.customer.select("c_custkey", "c_acctbal", "c_mktsegment")
    coded = one_hot(base, fit_values(base, ["c_mktsegment"]), ["c_custkey"])
    wide = attach_blocks(coded, {"lines": _line_block(t)}, "c_custkey")
    return stable_columns(fill_number(wide, 0, ["c_custkey"]), *LINE_NAMES)


REPLAYED = (
    FeatureSpec("f_0_line", "mul_feature_creator", ("l_quantity", "l_discount"), "line"),
    FeatureSpec("f_1_line", "atan2_feature_creator", ("f_0_line", "l_returnflag"), "line"),
    FeatureSpec("f_2_line", "divide_feature_creator", ("l_extendedprice", "f_0_line"), "line"),
    FeatureSpec("f_3_line", "euclidean_feature_creator", ("f_1_line", "l_tax"), "line"),
    FeatureSpec("f_4_line", "sum_feature_creator", ("l_linestatus", "f_2_line"), "line"),
)


@query(
    "spec_replay",
    f"""
    WITH coded AS (
      SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax,
             dense_rank() OVER (ORDER BY l_returnflag) - 1 AS l_returnflag,
             dense_rank() OVER (ORDER BY l_linestatus) - 1 AS l_linestatus FROM lineitem),
    a AS (SELECT *, l_quantity * l_discount AS f_0_line FROM coded),
    b AS (SELECT *, atan2(f_0_line, l_returnflag) AS f_1_line,
                 CASE WHEN f_0_line = 0 THEN l_extendedprice ELSE l_extendedprice / f_0_line END AS f_2_line FROM a),
    c AS (SELECT *, sqrt(f_1_line * f_1_line + l_tax * l_tax) AS f_3_line, l_linestatus + f_2_line AS f_4_line FROM b)
    SELECT l_orderkey, {", ".join(
        f"{st(f'avg({c})')} AS {c}_line_mean"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                  "f_0_line", "f_1_line", "f_2_line", "f_3_line", "f_4_line"))}
    FROM c GROUP BY l_orderkey
    """,
)
def spec_replay(spark, folder):
    lines = Tables(spark, folder).lineitem.select(
        "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"
    )
    specs = specs_of(spec_table(spark, REPLAYED))
    return all_stable(replay_block(lines, None, "l_orderkey", specs, "line"))


TABLE_SPECS = {
    "orders": (
        FeatureSpec("f_0_orders", "ratio_guarded", ("o_totalprice", "c_acctbal"), "orders"),
        FeatureSpec("f_1_orders", "sum", ("f_0_orders", "o_orderstatus"), "orders"),
    ),
    "events": (FeatureSpec("f_0_events", "product", ("value", "event_type"), "events"),),
    "lines": (
        FeatureSpec("f_0_lines", "product", ("l_quantity", "l_discount"), "lines"),
        FeatureSpec("f_1_lines", "angle", ("f_0_lines", "c_nationkey"), "lines"),
    ),
}
FOLDED = [
    "o_totalprice_orders_mean", "o_orderstatus_orders_mean", "f_0_orders_orders_mean", "f_1_orders_orders_mean",
    "value_events_mean", "event_type_events_mean", "f_0_events_events_mean",
    "l_quantity_lines_mean", "l_discount_lines_mean", "f_0_lines_lines_mean", "f_1_lines_lines_mean",
]


def _means(columns: list[str], name: str) -> str:
    return ", ".join(f"avg({c}) AS {c}_{name}_mean" for c in columns)


@query(
    "replay_all_tables",
    f"""
    WITH o AS (
      SELECT c_custkey, {_means(["o_totalprice", "o_orderstatus", "f_0_orders", "f_1_orders"], "orders")} FROM (
        SELECT *, f_0_orders + o_orderstatus AS f_1_orders FROM (
          SELECT o_custkey AS c_custkey, o_totalprice, dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS o_orderstatus,
                 CASE WHEN coalesce(c_acctbal, 0) = 0 THEN o_totalprice ELSE o_totalprice / c_acctbal END AS f_0_orders
          FROM orders LEFT JOIN customer ON c_custkey = o_custkey)) GROUP BY c_custkey),
    e AS (
      SELECT c_custkey, {_means(["value", "event_type", "f_0_events"], "events")} FROM (
        SELECT *, value * event_type AS f_0_events FROM (
          SELECT user_id AS c_custkey, value, dense_rank() OVER (ORDER BY event_type) - 1 AS event_type FROM events))
      GROUP BY c_custkey),
    l AS (
      SELECT c_custkey, {_means(["l_quantity", "l_discount", "f_0_lines", "f_1_lines"], "lines")} FROM (
        SELECT *, atan2(f_0_lines, c_nationkey) AS f_1_lines FROM (
          SELECT o_custkey AS c_custkey, coalesce(c_nationkey, 0) AS c_nationkey, l_quantity, l_discount, l_quantity * l_discount AS f_0_lines
          FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey))
      GROUP BY c_custkey)
    SELECT c_custkey, {", ".join(f"{st(f'coalesce({c}, 0)')} AS {c}" for c in FOLDED)}, coalesce(c_acctbal, 0) AS c_acctbal,
           coalesce(c_nationkey, 0) AS c_nationkey, coalesce(segment, 0) AS c_mktsegment
    FROM o FULL JOIN e USING (c_custkey) FULL JOIN l USING (c_custkey)
         LEFT JOIN (SELECT *, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS segment FROM customer) USING (c_custkey)
    """,
)
def replay_all_tables(spark, folder):
    t = Tables(spark, folder)
    return _replayed(t, t.orders, t.customer)


def _replayed(t, orders, customers):
    owner = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    children = {
        "orders": orders.select(F.col("o_custkey").alias("c_custkey"), "o_totalprice", "o_orderstatus"),
        "events": t.events.select(F.col("user_id").alias("c_custkey"), "value", "event_type"),
        "lines": t.lineitem.select("l_orderkey", "l_quantity", "l_discount").transform(
            lambda lines: attach_by_key(lines, owner, ["l_orderkey"], "inner")
        ).drop("l_orderkey"),
    }
    base = customers.select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    return stable_columns(replay_tables(children, base, "c_custkey", TABLE_SPECS), *FOLDED)


# the orders of some customers belong to entities that the customer table lacks, those of one to nobody
OWNER = "CASE WHEN o_custkey <= 30 THEN -o_custkey ELSE nullif(o_custkey, 31) END"


@query(
    "replay_whole_tables",
    f"""
    WITH owned AS (SELECT * REPLACE ({OWNER} AS o_custkey) FROM orders),
    o AS (
      SELECT c_custkey, {_means(["o_totalprice", "o_orderstatus", "f_0_orders", "f_1_orders"], "orders")} FROM (
        SELECT *, f_0_orders + o_orderstatus AS f_1_orders FROM (
          SELECT o_custkey AS c_custkey, o_totalprice, dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS o_orderstatus,
                 CASE WHEN coalesce(c_acctbal, 0) = 0 THEN o_totalprice ELSE o_totalprice / c_acctbal END AS f_0_orders
          FROM owned LEFT JOIN customer ON c_custkey = o_custkey)) WHERE c_custkey IS NOT NULL GROUP BY c_custkey),
    e AS (
      SELECT c_custkey, {_means(["value", "event_type", "f_0_events"], "events")} FROM (
        SELECT *, value * event_type AS f_0_events FROM (
          SELECT user_id AS c_custkey, value, dense_rank() OVER (ORDER BY event_type) - 1 AS event_type FROM events))
      WHERE c_custkey IS NOT NULL GROUP BY c_custkey),
    l AS (
      SELECT c_custkey, {_means(["l_quantity", "l_discount", "f_0_lines", "f_1_lines"], "lines")} FROM (
        SELECT *, atan2(f_0_lines, c_nationkey) AS f_1_lines FROM (
          SELECT o_custkey AS c_custkey, coalesce(c_nationkey, 0) AS c_nationkey, l_quantity, l_discount, l_quantity * l_discount AS f_0_lines
          FROM lineitem JOIN owned ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey))
      WHERE c_custkey IS NOT NULL GROUP BY c_custkey)
    SELECT c_custkey, {", ".join(f"{st(f'coalesce({c}, 0)')} AS {c}" for c in FOLDED)}, coalesce(c_acctbal, 0) AS c_acctbal,
           coalesce(c_nationkey, 0) AS c_nationkey, coalesce(segment, 0) AS c_mktsegment
    FROM o FULL JOIN e USING (c_custkey) FULL JOIN l USING (c_custkey)
         LEFT JOIN (SELECT *, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS segment FROM customer) USING (c_custkey)
    """,
)
def replay_whole_tables(spark, folder):
    """The whole customer table as base; child rows of unknown customers and of none."""
    t = Tables(spark, folder)
    return _replayed(t, t.orders.withColumn("o_custkey", F.expr(OWNER)), t.customer)


@query(
    "staged_blocks",
    f"""
    SELECT o_custkey, {st("avg(price)")} AS price, CAST(sum(n_lines) AS BIGINT) AS n_lines, max(o_totalprice) AS dearest
    FROM orders LEFT JOIN (SELECT l_orderkey, avg(l_extendedprice) AS price, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey)
      ON l_orderkey = o_orderkey
    WHERE o_custkey IS NOT NULL GROUP BY o_custkey
    """,
)
def staged_blocks(spark, folder):
    """Lines per order, joined and rolled up per customer; each of the three is a stage that another run picks up."""
    t, stages = Tables(spark, folder), Stages(spark)
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.avg("l_extendedprice").alias("price"), F.count(F.lit(1)).alias("n_lines")
    )
    lines = stages.stage("lines_per_order", lines)
    orders = stages.stage("orders_with_lines", t.orders.select("o_orderkey", "o_custkey", "o_totalprice").join(lines, "o_orderkey", "left"))
    rolled = orders.filter("o_custkey IS NOT NULL").groupBy("o_custkey")
    rolled = rolled.agg(F.avg("price").alias("price"), F.sum("n_lines").alias("n_lines"), F.max("o_totalprice").alias("dearest"))
    return stable_columns(stages.stage("customers", rolled), "price")
