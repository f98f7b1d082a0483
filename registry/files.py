"""Sources and sinks as round trips through the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from basketry.operators import combine, evaluate, popularity, profile, related
from basketry.plans import recommend
from basketry.sources import tables
from basketry.sources.lineage import ensure_checkpoint_dir
from registry import fragments as f
from registry.base import query
from registry.fixtures import CLICKS_LAST, CLICKS_WINDOWS, clicks, clicks_sql, retail, retail_sql
from registry.recommenders import pairs_sql

W1, W2, *_ = CLICKS_WINDOWS


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"


def _csv(df, compression: str = "none") -> str:
    path = _folder(df.sparkSession)
    df.write.option("header", True).option("compression", compression).csv(path)
    return path


ROWS_SQL = clicks_sql("SELECT t_dat, customer_id, article_id, round(price, 6) AS price, sales_channel_id FROM tx")


def _rounded(tx):
    return tx.withColumn("price", F.round("price", 6))


@query("read_csv_typed", ROWS_SQL)
def read_csv_typed(spark, sf_dir):
    tx = clicks(spark, sf_dir).tx
    other_order = tx.select("sales_channel_id", "price", "article_id", "customer_id", "t_dat")
    return _rounded(tables.read_transactions_csv(spark, _csv(other_order)))


@query("read_csv_gz", ROWS_SQL)
def read_csv_gz(spark, sf_dir):
    return _rounded(tables.read_transactions_csv(spark, _csv(clicks(spark, sf_dir).tx, "gzip"), partitions=8))


@query("read_parquet", clicks_sql("SELECT customer_id, article_id FROM tx"))
def read_parquet(spark, sf_dir):
    path = _folder(spark)
    clicks(spark, sf_dir).tx.write.parquet(path)
    return tables.read_parquet(spark, path, ["customer_id", "article_id"])


@query("snapshot", clicks_sql("SELECT *, strftime(t_dat, '%Y-%m') AS month FROM (SELECT t_dat, customer_id, article_id, round(price, 6) AS price, sales_channel_id FROM tx)"))
def snapshot(spark, sf_dir):
    back = tables.snapshot_by_month(clicks(spark, sf_dir).tx, _folder(spark), files_per_month=2)
    return _rounded(back).withColumn("month", F.col("month").cast("string"))


@query("read_population", retail_sql("SELECT customer_id FROM population"))
def read_population(spark, sf_dir):
    everyone = retail(spark, sf_dir).population
    return tables.read_population(spark, _csv(everyone.withColumn("prediction", F.lit(""))))


HISTORY_SQL = clicks_sql(
    ",".join([f.history("own", W2[0], W1[1]), f.popular("pop", W2[0], W1[1]), f.cut([f.own("own"), f.fill("pop")])]) + f.PREDICTIONS
)


def _predictions(spark, sf_dir):
    shop = clicks(spark, sf_dir)
    lists = recommend.history_fill(shop.tx, shop.population, W2[0], W1[1])
    path = _folder(spark)
    tables.write_predictions(combine.to_predictions(lists), path)
    return shop, spark.read.option("header", True).schema("customer_id string, prediction string").csv(path)


@query("write_predictions", HISTORY_SQL)
def write_predictions(spark, sf_dir):
    """The rows of the file."""
    return _predictions(spark, sf_dir)[1]


@query("submission_check", "SELECT 0 AS missing, 0 AS unknown, 0 AS repeated FROM (SELECT count(*) FROM events)")
def submission_check(spark, sf_dir):
    shop, back = _predictions(spark, sf_dir)
    return evaluate.submission_check(back, shop.population)


@query(
    "submission_check_faults",
    clicks_sql(
        """ends AS (SELECT min(customer_id) AS low, max(customer_id) AS high FROM population)
        SELECT count(*) FILTER (WHERE customer_id = low) AS missing, 1::BIGINT AS unknown,
               count(*) FILTER (WHERE customer_id = high) AS repeated FROM population, ends"""
    ),
)
def submission_check_faults(spark, sf_dir):
    """A file without the first customer, with the last one twice and one that nobody knows."""
    shop, back = _predictions(spark, sf_dir)
    low, high = back.agg(F.min("customer_id"), F.max("customer_id")).first()
    faulty = back.where(F.col("customer_id") != low).unionByName(back.where(F.col("customer_id") == high))
    stranger = back.where(F.col("customer_id") == high).withColumn("customer_id", F.lit("nobody"))
    return evaluate.submission_check(faulty.unionByName(stranger), shop.population)


@query(
    "write_intermediate",
    clicks_sql("SELECT customer_id, article_id, count(*) AS n FROM tx GROUP BY 1, 2"),
)
def write_intermediate(spark, sf_dir):
    counts = clicks(spark, sf_dir).tx.groupBy("customer_id", "article_id").agg(F.count("*").alias("n"))
    return tables.write_intermediate(counts, _folder(spark))


@query(
    "read_pairs",
    clicks_sql(pairs_sql(CLICKS_LAST, 7) + " SELECT article_id, article_id2 FROM pairs"),
)
def read_pairs(spark, sf_dir):
    path = _folder(spark)
    related.copurchase_pairs(clicks(spark, sf_dir).tx, CLICKS_LAST).write.parquet(path)
    return tables.read_pairs(spark, path)


@query(
    "table_overview",
    clicks_sql(
        """SELECT article_id, CAST(n AS BIGINT) AS n, count(*) OVER () AS n_rows, 2 AS n_columns,
               'struct<article_id:string,n:bigint>' AS table_schema
        FROM (SELECT article_id, count(*) AS n FROM tx GROUP BY 1) ORDER BY article_id LIMIT 5"""
    ),
)
def table_overview(spark, sf_dir):
    counts = popularity.article_counts(clicks(spark, sf_dir).tx).orderBy("article_id")
    seen = profile.table_overview(counts)
    return seen["head"].select(
        "article_id",
        "n",
        F.lit(seen["rows"]).cast("long").alias("n_rows"),
        F.lit(seen["columns"]).alias("n_columns"),
        F.lit(seen["schema"]).alias("table_schema"),
    )


@query(
    "weekly_counts_incremental",
    clicks_sql(f"SELECT {f.bucket(CLICKS_LAST, 7)} AS week_end, article_id, count(*) AS n FROM tx GROUP BY 1, 2"),
)
def weekly_counts_incremental(spark, sf_dir):
    """Days arrive in two parts, the first one cut short, and some twice."""
    tx, path = clicks(spark, sf_dir).tx, _folder(spark)
    tables.update_daily_counts(tx.where((F.col("t_dat") < F.lit(W1[0])) | (F.col("sales_channel_id") == 1)), path)
    counts = tables.update_daily_counts(tx.where(F.col("t_dat") >= F.lit(W2[0])), path)
    return popularity.weekly_of_daily(counts, CLICKS_LAST)


@query("history_fill_bucketed", HISTORY_SQL)
def history_fill_bucketed(spark, sf_dir):
    shop = clicks(spark, sf_dir)
    tx = tables.snapshot_by_customer(shop.tx, f"purchases_{uuid.uuid4().hex}", 8, _folder(spark))
    return combine.to_predictions(recommend.history_fill(tx, shop.population, W2[0], W1[1]))
