"""Input views over the given tables, in Spark and as SQL for the checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


NUMERIC = [
    "o_totalprice", "c_acctbal", "n_lines", "qty_sum", "price_sum", "disc_avg", "tax_avg", "span_days",
]
EVENT_COLUMNS = ["ev_n", "ev_sum", "ev_max"]
NOMINAL = ["o_orderpriority", "o_orderstatus", "c_mktsegment", "n_name"]


def order_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: line, customer and event aggregates, with real nulls."""
    li = table(spark, sf_dir, "lineitem")
    lines = li.groupBy(F.col("l_orderkey").alias("row_id")).agg(
        F.count(F.lit(1)).cast("double").alias("n_lines"),
        F.sum("l_quantity").alias("qty_sum"),
        F.round(F.sum("l_extendedprice"), 2).alias("price_sum"),
        F.round(F.avg("l_discount"), 6).alias("disc_avg"),
        F.round(F.avg("l_tax"), 6).alias("tax_avg"),
        F.date_diff(F.max("l_shipdate"), F.min("l_shipdate")).cast("double").alias("span_days"),
        F.min(F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))).alias("first_return"),
    )
    events = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.count(F.lit(1)).cast("double").alias("ev_n"),
        F.round(F.sum("value"), 2).alias("ev_sum"), F.max("value").alias("ev_max"),
    )
    customers = (
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
        .join(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey", "left")
        .join(events, "c_custkey", "left")
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("c_custkey"),
        "o_totalprice", "o_orderpriority", "o_orderstatus",
    )
    months = (F.year("first_return") - 1992) * 12 + F.month("first_return") - 1
    return (
        orders.join(lines, "row_id", "left").join(customers, "c_custkey", "left")
        .withColumn("mths_since_return", months.cast("double"))
        .select("row_id", *NUMERIC, "mths_since_return", *EVENT_COLUMNS, *NOMINAL)
    )


PROFILE = """
li AS (
  SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS n_lines, sum(l_quantity) AS qty_sum,
         round(sum(l_extendedprice), 2) AS price_sum, round(avg(l_discount), 6) AS disc_avg,
         round(avg(l_tax), 6) AS tax_avg,
         CAST(date_diff('day', CAST(min(l_shipdate) AS DATE), CAST(max(l_shipdate) AS DATE)) AS DOUBLE) AS span_days,
         min(CASE WHEN l_returnflag = 'R' THEN l_shipdate END) AS first_return
  FROM lineitem GROUP BY l_orderkey),
ev AS (
  SELECT user_id, CAST(count(*) AS DOUBLE) AS ev_n, round(sum(value), 2) AS ev_sum, max(value) AS ev_max
  FROM events GROUP BY user_id),
profile AS (
  SELECT o_orderkey AS row_id, o_totalprice, c_acctbal, n_lines, qty_sum, price_sum, disc_avg, tax_avg, span_days,
         CAST((year(first_return) - 1992) * 12 + month(first_return) - 1 AS DOUBLE) AS mths_since_return,
         ev_n, ev_sum, ev_max, o_orderpriority, o_orderstatus, c_mktsegment, n_name
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN li ON l_orderkey = o_orderkey LEFT JOIN ev ON user_id = c_custkey)
"""


def full_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that have lines, numeric columns only: the null-free matrix of the studies."""
    return order_profile(spark, sf_dir).select("row_id", *NUMERIC, "o_orderpriority", "o_orderstatus", "c_mktsegment").where(
        F.col("n_lines").isNotNull()
    )


FULL = PROFILE + """,
fullp AS (SELECT row_id, o_totalprice, c_acctbal, n_lines, qty_sum, price_sum, disc_avg, tax_avg, span_days,
                 o_orderpriority, o_orderstatus, c_mktsegment FROM profile WHERE n_lines IS NOT NULL)
"""


def customer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: scaled balance and spending, segment and spending band."""
    spent = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("row_id")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("spent"), F.count(F.lit(1)).alias("n_orders"),
    )
    return (
        table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("row_id"), "c_acctbal", "c_mktsegment", "c_nationkey")
        .join(spent, "row_id", "left")
        .select(
            "row_id", (F.col("c_acctbal") / 1000).alias("x"), (F.coalesce("spent", F.lit(0.0)) / 250000).alias("y"),
            F.coalesce("n_orders", F.lit(0)).alias("n_orders"), "c_mktsegment", "c_nationkey",
            F.when(F.coalesce("spent", F.lit(0.0)) > 2500000, 1).otherwise(0).alias("big"),
        )
    )


CUSTOMERS = """
spent AS (SELECT o_custkey, round(sum(o_totalprice), 2) AS spent, count(*) AS n_orders FROM orders GROUP BY o_custkey),
cust AS (
  SELECT c_custkey AS row_id, c_acctbal / 1000 AS x, coalesce(spent, 0.0) / 250000 AS y,
         coalesce(n_orders, 0) AS n_orders, c_mktsegment, c_nationkey,
         CASE WHEN coalesce(spent, 0.0) > 2500000 THEN 1 ELSE 0 END AS big
  FROM customer LEFT JOIN spent ON o_custkey = c_custkey)
"""


def event_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with derived heavy-tailed, zero-inflated, constant and text columns."""
    ev = table(spark, sf_dir, "events")
    v = F.col("value")
    return ev.select(
        F.col("event_id").alias("row_id"), "user_id", "event_type", v.alias("value"), (v * v).alias("heavy"),
        F.when(F.col("event_id") % 200 == 0, v).otherwise(0.0).alias("spike"), F.lit(1).alias("one"),
        F.concat(v.cast("string"), F.lit("%")).alias("pct_text"),
    )


EVENTS = """
evv AS (
  SELECT event_id AS row_id, user_id, event_type, value, value * value AS heavy,
         CASE WHEN event_id % 200 = 0 THEN value ELSE 0.0 END AS spike, 1 AS one
  FROM events)
"""
