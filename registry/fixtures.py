"""The driver's tables seen as purchases, customers and articles.

``retail`` joins orders and line items and has attributes; its windows are 90
days. ``clicks`` takes the purchase events; its windows are 7 days. The SQL
fragments define the same tables for the comparison engine.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.windows import back_windows
from basketry.sources.tables import spread

CLICKS_DAYS = 7
CLICKS_LAST = dt.date(2024, 1, 30)
CLICKS_REF = dt.date(2024, 1, 24)
CLICKS_END = dt.date(2024, 1, 31)
CLICKS_WINDOWS = back_windows(CLICKS_REF, CLICKS_DAYS, 5)

RETAIL_DAYS = 90
RETAIL_LAST = dt.date(2001, 8, 1)
RETAIL_END = dt.date(2001, 8, 2)
RETAIL_REF = RETAIL_END - dt.timedelta(days=RETAIL_DAYS)
RETAIL_WINDOWS = back_windows(RETAIL_REF, RETAIL_DAYS, 5)
# Days of the blend, stretched by 13 as a week becomes 91 days.
RETAIL_STRETCH = 13


@dataclass(frozen=True)
class Shop:
    tx: DataFrame
    customers: DataFrame | None
    articles: DataFrame | None
    population: DataFrame


# The columns of the driver's tables, so that no job infers them.
TABLES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def _id(column: str):
    return F.lpad(F.col(column).cast("string"), 10, "0")


def retail(spark: SparkSession, sf_dir: str) -> Shop:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    tx = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderdate").cast("date").alias("t_dat"),
        _id("o_custkey").alias("customer_id"),
        _id("l_partkey").alias("article_id"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.when(urgent, 1).otherwise(2).alias("sales_channel_id"),
    )
    customers = table(spark, sf_dir, "customer").select(
        _id("c_custkey").alias("customer_id"),
        F.when(F.col("c_acctbal") >= 0, F.floor(F.col("c_acctbal") / 100).cast("int")).alias("age"),
        F.col("c_mktsegment").alias("club_member_status"),
    )
    articles = table(spark, sf_dir, "part").select(
        _id("p_partkey").alias("article_id"),
        F.concat_ws(" ", "p_name", "p_brand").alias("prod_name"),
        F.floor(F.col("p_partkey") / 10).cast("int").alias("product_code"),
        F.col("p_type").alias("product_group_name"),
    )
    return Shop(tx, customers, articles, customers.select("customer_id"))


def clicks(spark: SparkSession, sf_dir: str) -> Shop:
    events = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    tx = events.select(
        F.col("ts").cast("date").alias("t_dat"),
        _id("user_id").alias("customer_id"),
        F.lpad(F.get_json_object("props", "$.k"), 10, "0").alias("article_id"),
        F.col("value").alias("price"),
        F.when(F.col("event_id") % 3 == 0, 1).otherwise(2).alias("sales_channel_id"),
    )
    return Shop(tx, None, None, tx.select("customer_id").distinct())


RETAIL_SQL = """
tx AS (
  SELECT CAST(o_orderdate AS DATE) AS t_dat,
         lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS customer_id,
         lpad(CAST(l_partkey AS VARCHAR), 10, '0') AS article_id,
         l_extendedprice / l_quantity AS price,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 2 END AS sales_channel_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
customers AS (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS customer_id,
         CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal / 100) AS INT) END AS age,
         c_mktsegment AS club_member_status
  FROM customer),
articles AS (
  SELECT lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS article_id,
         p_name || ' ' || p_brand AS prod_name,
         CAST(floor(p_partkey / 10) AS INT) AS product_code,
         p_type AS product_group_name
  FROM part),
population AS (SELECT customer_id FROM customers)"""

CLICKS_SQL = """
tx AS (
  SELECT CAST(ts AS DATE) AS t_dat,
         lpad(CAST(user_id AS VARCHAR), 10, '0') AS customer_id,
         lpad(json_extract_string(props, '$.k'), 10, '0') AS article_id,
         value AS price,
         CASE WHEN event_id % 3 = 0 THEN 1 ELSE 2 END AS sales_channel_id
  FROM events WHERE event_type = 'purchase'),
population AS (SELECT DISTINCT customer_id FROM tx)"""


def _with(tables: str, rest: str) -> str:
    joiner = "\n" if rest.lstrip().upper().startswith("SELECT") else ",\n"
    return f"WITH {tables.strip()}{joiner}{rest.strip()}"


def retail_sql(rest: str) -> str:
    return _with(RETAIL_SQL, rest)


def clicks_sql(rest: str) -> str:
    return _with(CLICKS_SQL, rest)
