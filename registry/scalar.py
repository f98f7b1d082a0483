"""Keys, dates, decay weights, filters and list functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry.functions import dates, keys, lists
from basketry.operators import history, popularity, windows
from basketry.operators.combine import to_lists
from basketry.operators.factor import dense_ids
from basketry.operators.profile import text_lengths
from basketry.plans.recommend import popular_literal
from registry import fragments as f
from registry.base import query
from registry.fixtures import (
    CLICKS_LAST,
    CLICKS_REF,
    CLICKS_WINDOWS,
    clicks,
    clicks_sql,
    retail,
    retail_sql,
    documents,
)

W1, W2, W3, W4, W5 = CLICKS_WINDOWS
TRAIN_SQL = f"SELECT * FROM tx WHERE {f.window(W2[0], W1[1])}"


@query(
    "hash_key",
    retail_sql(
        """
h AS (SELECT customer_id, CAST('0x' || right(sha256(customer_id), 16) AS UBIGINT) AS u FROM customers)
SELECT customer_id,
       CAST(CASE WHEN u >= 9223372036854775808 THEN CAST(u AS HUGEINT) - 18446744073709551616
                 ELSE u END AS BIGINT) AS signed_key,
       CAST(u AS VARCHAR) AS unsigned_key
FROM h"""
    ),
)
def hash_key(spark, sf_dir):
    digest = F.sha2("customer_id", 256)
    return retail(spark, sf_dir).customers.select(
        "customer_id",
        keys.hash_key(digest).alias("signed_key"),
        keys.hash_key(digest, signed=False).cast("string").alias("unsigned_key"),
    )


@query(
    "article_key",
    retail_sql(
        """SELECT article_id, CAST(article_id AS BIGINT) AS article_number,
           lpad(CAST(CAST(article_id AS BIGINT) AS VARCHAR), 10, '0') AS article_label FROM articles"""
    ),
)
def article_key(spark, sf_dir):
    number = keys.article_key("article_id")
    return retail(spark, sf_dir).articles.select(
        "article_id",
        number.alias("article_number"),
        keys.article_label(number).alias("article_label"),
    )


@query(
    "to_date",
    clicks_sql(
        "SELECT customer_id, article_id, CAST(strftime(t_dat, '%d/%m/%Y') AS VARCHAR) AS t_text, t_dat FROM tx"
    ),
)
def to_date(spark, sf_dir):
    tx = clicks(spark, sf_dir).tx
    text = tx.select(
        "customer_id", "article_id", F.date_format("t_dat", "dd/MM/yyyy").alias("t_text")
    )
    return text.withColumn("t_dat", dates.to_date("t_text", "dd/MM/yyyy"))


@query(
    "date_parts",
    clicks_sql(
        """SELECT customer_id, article_id, t_dat, CAST(year(t_dat) AS INTEGER) AS year,
           CAST(month(t_dat) AS INTEGER) AS month, CAST(day(t_dat) AS INTEGER) AS day,
           CAST(isodow(t_dat) - 1 AS INTEGER) AS dayofweek FROM tx"""
    ),
)
def date_parts(spark, sf_dir):
    return clicks(spark, sf_dir).tx.select(
        "customer_id", "article_id", "t_dat", *dates.date_parts("t_dat")
    )


@query(
    "text_lengths",
    r"""SELECT doc_id, lang, CAST(length(text) AS BIGINT) AS string_count,
       CAST(len(regexp_extract_all(text, '\S+')) AS BIGINT) AS word_count
       FROM documents WHERE text IS NOT NULL""",
)
def text_lengths_query(spark, sf_dir):
    return text_lengths(documents(spark, sf_dir), "text").select(
        "doc_id", "lang", "string_count", "word_count"
    )


@query(
    "day_diff",
    clicks_sql(
        """SELECT customer_id, article_id, t_dat,
           CAST((SELECT max(t_dat) FROM tx) - t_dat AS INTEGER) AS days FROM tx"""
    ),
)
def day_diff(spark, sf_dir):
    tx = clicks(spark, sf_dir).tx
    return tx.select(
        "customer_id",
        "article_id",
        "t_dat",
        dates.day_diff(windows.last_date(tx), "t_dat").alias("days"),
    )


@query(
    "week_bucket",
    clicks_sql(
        f"SELECT customer_id, article_id, t_dat, {f.bucket(CLICKS_LAST, 7)} AS week_end FROM tx"
    ),
)
def week_bucket(spark, sf_dir):
    return clicks(spark, sf_dir).tx.select(
        "customer_id",
        "article_id",
        "t_dat",
        dates.week_bucket("t_dat", CLICKS_LAST).alias("week_end"),
    )


@query(
    "week_id",
    clicks_sql(
        f"""SELECT customer_id, article_id, t_dat,
            CAST(104 - floor((DATE '{CLICKS_LAST}' - t_dat) / 7.0) AS INTEGER) AS week FROM tx"""
    ),
)
def week_id(spark, sf_dir):
    return clicks(spark, sf_dir).tx.select(
        "customer_id", "article_id", "t_dat", dates.week_id("t_dat", CLICKS_LAST).alias("week")
    )


AGE_BIN_SQL = """coalesce(CASE WHEN age > -1 AND age <= 19 THEN 0 WHEN age > 19 AND age <= 29 THEN 1
  WHEN age > 29 AND age <= 39 THEN 2 WHEN age > 39 AND age <= 49 THEN 3
  WHEN age > 49 AND age <= 59 THEN 4 WHEN age > 59 AND age <= 69 THEN 5
  WHEN age > 69 AND age <= 119 THEN 6 END, 0)"""


@query(
    "bin_column",
    retail_sql(f"SELECT customer_id, age, CAST({AGE_BIN_SQL} AS INTEGER) AS age_bin FROM customers"),
)
def bin_column(spark, sf_dir):
    return retail(spark, sf_dir).customers.select(
        "customer_id", "age", keys.bin_column("age", popularity.AGE_EDGES).alias("age_bin")
    )


@query(
    "dense_ids",
    retail_sql(
        """SELECT count(DISTINCT customer_id) AS keys, count(DISTINCT customer_id) AS ids,
           0 AS first_id, CAST(count(DISTINCT customer_id) - 1 AS INTEGER) AS last_id FROM tx"""
    ),
)
def dense_ids_query(spark, sf_dir):
    return dense_ids(retail(spark, sf_dir).tx, "customer_id", "user").agg(
        F.count_distinct("customer_id").alias("keys"),
        F.count_distinct("user").alias("ids"),
        F.min("user").alias("first_id"),
        F.max("user").alias("last_id"),
    )


@query(
    "null_default",
    retail_sql("SELECT customer_id, coalesce(age, -1) AS age, age IS NULL AS was_missing FROM customers"),
)
def null_default(spark, sf_dir):
    return retail(spark, sf_dir).customers.select(
        "customer_id",
        keys.null_default("age", -1).alias("age"),
        F.col("age").isNull().alias("was_missing"),
    )


def _decay(name):
    def run(spark, sf_dir):
        tx = windows.date_window(clicks(spark, sf_dir).tx, W2[0], W1[1])
        days = dates.day_diff(CLICKS_REF, "t_dat")
        return tx.select(
            "customer_id",
            "article_id",
            days.alias("days"),
            F.round(dates.DECAYS[name](days), 6).alias("weight"),
        )

    return run


def _decay_sql(weight):
    return clicks_sql(
        f"""w AS (SELECT customer_id, article_id, CAST(DATE '{CLICKS_REF}' - t_dat AS INTEGER) AS days
                 FROM ({TRAIN_SQL}))
        SELECT customer_id, article_id, days, round({weight}, 6) AS weight FROM w"""
    )


query("decay_inverse_days", _decay_sql("1.0::DOUBLE / days"))(_decay("inverse"))
query("decay_exp", _decay_sql("exp(-days::DOUBLE)"))(_decay("exp"))
query(
    "decay_mixed",
    _decay_sql(
        """greatest(0.0::DOUBLE, 2.5e4 / sqrt(greatest(1, days)::DOUBLE)
           + 1.5e5 * exp(-0.2::DOUBLE * greatest(1, days)) - 1e3)"""
    ),
)(_decay("mixed"))


@query(
    "product_code",
    retail_sql(
        """SELECT article_id, CAST(floor(CAST(article_id AS BIGINT) / 10) AS BIGINT) AS from_id,
           product_code FROM articles"""
    ),
)
def product_code(spark, sf_dir):
    return retail(spark, sf_dir).articles.select(
        "article_id", keys.product_code("article_id", 10).alias("from_id"), "product_code"
    )


HISTORY_SQL = f.history("own", W2[0], W1[1])


@query(
    "ids_to_string",
    clicks_sql(
        HISTORY_SQL
        + """
SELECT customer_id, string_agg(article_id, ' ' ORDER BY rank) AS prediction,
       CAST(count(*) AS INTEGER) AS n_items, min(CASE WHEN rank = 1 THEN article_id END) AS first_item
FROM own GROUP BY 1"""
    ),
)
def ids_to_string(spark, sf_dir):
    own = to_lists(history.history_items(clicks(spark, sf_dir).tx, W2[0], W1[1]))
    text = own.select("customer_id", keys.ids_to_string("items").alias("prediction"))
    back = keys.string_to_ids("prediction")
    return text.select(
        "customer_id",
        "prediction",
        F.size(back).alias("n_items"),
        F.element_at(back, 1).alias("first_item"),
    )


@query(
    "truncate_string",
    clicks_sql(
        f.history("own", W4[0], W1[1], 20)
        + """,
joined AS (SELECT customer_id, ' ' || string_agg(article_id, ' ' ORDER BY rank) AS all_items FROM own GROUP BY 1)
SELECT customer_id, substring(trim(all_items), 1, 131) AS prediction FROM joined"""
    ),
)
def truncate_string(spark, sf_dir):
    own = to_lists(history.history_items(clicks(spark, sf_dir).tx, W4[0], W1[1], 20), k=20)
    text = F.concat(F.lit(" "), keys.ids_to_string("items"))
    return own.select("customer_id", keys.truncate_prediction(text).alias("prediction"))


@query(
    "prune_columns",
    clicks_sql("SELECT t_dat AS bought_on, customer_id, article_id FROM tx"),
)
def prune_columns(spark, sf_dir):
    tx = clicks(spark, sf_dir).tx
    return tx.drop("price", "sales_channel_id").withColumnRenamed("t_dat", "bought_on")


@query(
    "date_window",
    clicks_sql(
        f.numbered("w", CLICKS_WINDOWS[:4])
        + " SELECT window_no, t_dat, customer_id, article_id FROM w"
    ),
)
def date_window(spark, sf_dir):
    return windows.numbered_windows(clicks(spark, sf_dir).tx, CLICKS_WINDOWS[:4]).select(
        "window_no", "t_dat", "customer_id", "article_id"
    )


@query(
    "trailing_window",
    clicks_sql(
        f"""SELECT t_dat, customer_id, article_id FROM tx
            WHERE t_dat BETWEEN DATE '{CLICKS_LAST}' - 4 AND DATE '{CLICKS_LAST}'"""
    ),
)
def trailing_window(spark, sf_dir):
    return windows.trailing_window(clicks(spark, sf_dir).tx, CLICKS_LAST, 4).select(
        "t_dat", "customer_id", "article_id"
    )


@query(
    "customer_recency",
    clicks_sql(
        """SELECT t_dat, customer_id, article_id, l_dat FROM (
             SELECT *, max(t_dat) OVER (PARTITION BY customer_id) AS l_dat FROM tx)
           WHERE l_dat - t_dat <= 6"""
    ),
)
def customer_recency(spark, sf_dir):
    return windows.customer_recency(clicks(spark, sf_dir).tx, 6).select(
        "t_dat", "customer_id", "article_id", "l_dat"
    )


@query(
    "channel_filter",
    clicks_sql("SELECT t_dat, customer_id, article_id, price FROM tx WHERE sales_channel_id = 1"),
)
def channel_filter(spark, sf_dir):
    return windows.channel_filter(clicks(spark, sf_dir).tx, 1).select(
        "t_dat", "customer_id", "article_id", "price"
    )


@query(
    "not_null",
    retail_sql("SELECT customer_id, age FROM customers WHERE age IS NOT NULL AND age > 0"),
)
def not_null(spark, sf_dir):
    return retail(spark, sf_dir).customers.where(
        F.col("age").isNotNull() & (F.col("age") > 0)
    ).select("customer_id", "age")


@query(
    "sold_recently",
    clicks_sql(
        f"""SELECT t_dat, customer_id, article_id FROM tx WHERE article_id IN (
              SELECT article_id FROM tx
              WHERE t_dat BETWEEN DATE '{CLICKS_LAST}' - 1 AND DATE '{CLICKS_LAST}')"""
    ),
)
def sold_recently(spark, sf_dir):
    tx = clicks(spark, sf_dir).tx
    return windows.sold_recently(tx, tx, CLICKS_LAST, 1).select(
        "t_dat", "customer_id", "article_id"
    )


POPULAR_SQL = f.popular("pop", W2[0], W1[1])


@query(
    "list_fill",
    clicks_sql(
        ",".join([HISTORY_SQL, POPULAR_SQL, f.cut([f.own("own"), f.fill("pop", who="(SELECT DISTINCT customer_id FROM own)")])])
        + f.PREDICTIONS
    ),
)
def list_fill(spark, sf_dir):
    tx = clicks(spark, sf_dir).tx
    own = to_lists(history.history_items(tx, W2[0], W1[1]))
    filled = lists.list_fill("items", popular_literal(tx, W2[0], W1[1]))
    return own.select("customer_id", keys.ids_to_string(filled).alias("prediction"))


@query(
    "list_cut",
    clicks_sql(
        HISTORY_SQL
        + """
SELECT customer_id, string_agg(article_id, ' ' ORDER BY rank) AS prediction
FROM own WHERE rank <= 4 GROUP BY 1"""
    ),
)
def list_cut(spark, sf_dir):
    own = to_lists(history.history_items(clicks(spark, sf_dir).tx, W2[0], W1[1]))
    return own.select(
        "customer_id", keys.ids_to_string(lists.list_cut("items", 4)).alias("prediction")
    )
