"""Joins, aggregations, rankings and set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from basketry.functions import keys
from basketry.functions.dates import window_number
from basketry.functions.keys import ids_to_string
from basketry.functions.lists import or_empty
from basketry.operators import combine, history, popularity, profile, related, star, trend, windows
from basketry.operators.factor import normalised_feedback
from basketry.operators.skew import join_totals, top_per_group
from basketry.operators.trend import customer_article_score
from basketry.plans import recommend
from registry import fragments as f
from registry.base import query
from registry.fixtures import (
    CLICKS_END,
    CLICKS_LAST,
    CLICKS_REF,
    CLICKS_WINDOWS,
    RETAIL_DAYS,
    RETAIL_LAST,
    RETAIL_WINDOWS,
    clicks,
    clicks_sql,
    retail,
    retail_sql,
)
from registry.scalar import AGE_BIN_SQL

W1, W2, W3, W4, W5 = CLICKS_WINDOWS
Q1, Q2, Q3, Q4, Q5 = RETAIL_WINDOWS


# --- joins -----------------------------------------------------------------


@query(
    "star_join",
    retail_sql(
        """SELECT t.t_dat, t.customer_id, t.article_id, t.price, t.sales_channel_id,
           c.age, c.club_member_status, a.prod_name, a.product_code, a.product_group_name
           FROM tx t LEFT JOIN customers c ON c.customer_id = t.customer_id
           LEFT JOIN articles a ON a.article_id = t.article_id"""
    ),
)
def star_join(spark, sf_dir):
    shop = retail(spark, sf_dir)
    return star.star_join(shop.tx, shop.customers, shop.articles)


WEEKLY_SQL = f"""
dated AS (SELECT *, {f.bucket(RETAIL_LAST, RETAIL_DAYS)} AS week_end FROM tx),
weekly AS (SELECT week_end, article_id, count(*) AS n FROM dated GROUP BY 1, 2)"""


@query(
    "weekly_sales_join",
    retail_sql(
        WEEKLY_SQL
        + """ SELECT d.t_dat, d.customer_id, d.article_id, d.week_end, w.n
        FROM dated d LEFT JOIN weekly w ON w.week_end = d.week_end AND w.article_id = d.article_id"""
    ),
)
def weekly_sales_join(spark, sf_dir):
    tx = retail(spark, sf_dir).tx
    return popularity.with_weekly_counts(tx, RETAIL_LAST, RETAIL_DAYS).select(
        "t_dat", "customer_id", "article_id", "week_end", "n"
    )


@query(
    "target_week_join",
    retail_sql(
        WEEKLY_SQL
        + f""" SELECT d.t_dat, d.customer_id, d.article_id, w.n, coalesce(l.n, 0) AS n_targ,
        round(coalesce(l.n, 0) / w.n::DOUBLE, 6) AS quotient
        FROM dated d JOIN weekly w ON w.week_end = d.week_end AND w.article_id = d.article_id
        LEFT JOIN weekly l ON l.week_end = DATE '{RETAIL_LAST}' AND l.article_id = d.article_id"""
    ),
)
def target_week_join(spark, sf_dir):
    tx = retail(spark, sf_dir).tx
    return popularity.with_weekly_counts(tx, RETAIL_LAST, RETAIL_DAYS).select(
        "t_dat", "customer_id", "article_id", "n", "n_targ",
        F.round(F.col("n_targ") / F.col("n"), 6).alias("quotient"),
    )


@query(
    "max_date_join",
    retail_sql(
        """SELECT t.t_dat, t.customer_id, t.article_id, m.l_dat FROM tx t
           JOIN (SELECT customer_id, max(t_dat) AS l_dat FROM tx GROUP BY 1) m
             ON m.customer_id = t.customer_id"""
    ),
)
def max_date_join(spark, sf_dir):
    tx = retail(spark, sf_dir).tx
    latest = tx.groupBy("customer_id").agg(F.max("t_dat").alias("l_dat"))
    return join_totals(tx, latest, ["customer_id"]).select(
        "t_dat", "customer_id", "article_id", "l_dat"
    )


CHANNEL_GROUP_SQL = """
channel_group AS (SELECT customer_id, CAST(round_even(avg(sales_channel_id), 0) AS INTEGER) AS segment
                  FROM tx GROUP BY 1),
groups AS (SELECT p.customer_id, coalesce(c.segment, 1) AS segment
           FROM population p LEFT JOIN channel_group c ON c.customer_id = p.customer_id)"""


@query(
    "population_join",
    retail_sql(
        f"""window_tx AS (SELECT * FROM tx WHERE {f.window(*Q1)}),
        counts AS (SELECT customer_id, count(*) AS n FROM window_tx GROUP BY 1)
        SELECT p.customer_id, coalesce(c.n, 0) AS n
        FROM population p LEFT JOIN counts c ON c.customer_id = p.customer_id"""
    ),
)
def population_join(spark, sf_dir):
    shop = retail(spark, sf_dir)
    counts = windows.date_window(shop.tx, *Q1).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    return shop.population.join(counts, "customer_id", "left").select(
        "customer_id", keys.null_default("n", F.lit(0).cast("bigint")).alias("n")
    )


VARIANT_SQL = f"""
counts AS (SELECT article_id, count(*) AS article_count, NULL::DOUBLE AS article_min_price FROM tx
           WHERE t_dat BETWEEN DATE '{RETAIL_LAST}' - 90 AND DATE '{RETAIL_LAST}' GROUP BY 1),
{f.best_other("variant", "counts", "product_code").strip()}"""


@query(
    "lookup_join",
    retail_sql(
        VARIANT_SQL
        + """ SELECT t.t_dat, t.customer_id, t.article_id, v.other_id AS variant_id
        FROM tx t LEFT JOIN variant v ON v.article_id = t.article_id"""
    ),
)
def lookup_join(spark, sf_dir):
    shop = retail(spark, sf_dir)
    lookup = related.variant_map(shop.tx, shop.articles, RETAIL_LAST, 90)
    return join_totals(shop.tx, lookup, ["article_id"], "left").select(
        "t_dat", "customer_id", "article_id", "variant_id"
    )


@query(
    "attach_predictions",
    retail_sql(
        f.history("own", *Q1)
        + """,
lists AS (SELECT * FROM own)"""
        + f.ALL_PREDICTIONS
    ),
)
def attach_predictions(spark, sf_dir):
    shop = retail(spark, sf_dir)
    own = combine.to_lists(history.history_items(shop.tx, *Q1))
    return combine.attach_predictions(shop.population, combine.to_predictions(own))


@query(
    "semi_join",
    retail_sql(
        f"""SELECT article_id, prod_name, product_code FROM articles
            WHERE article_id IN (SELECT article_id FROM tx WHERE {f.window(*Q1)})"""
    ),
)
def semi_join(spark, sf_dir):
    shop = retail(spark, sf_dir)
    sold = windows.date_window(shop.tx, *Q1).select("article_id").distinct()
    return shop.articles.join(sold, "article_id", "left_semi").select(
        "article_id", "prod_name", "product_code"
    )


@query(
    "sibling_self_join",
    retail_sql(
        f"""sold AS (SELECT article_id, count(*) AS n FROM tx WHERE {f.window(*Q1)} GROUP BY 1),
        counts AS (SELECT a.article_id, a.prod_name, coalesce(s.n, 0) AS n
                   FROM articles a LEFT JOIN sold s ON s.article_id = a.article_id),
        pairs AS (SELECT a.article_id, b.article_id AS other_id, b.n AS other_n,
                         count(*) OVER (PARTITION BY a.article_id) AS n_siblings,
                         row_number() OVER (PARTITION BY a.article_id ORDER BY b.n DESC, b.article_id) AS place
                  FROM counts a JOIN counts b ON b.prod_name = a.prod_name AND b.article_id <> a.article_id)
        SELECT c.article_id, coalesce(p.n_siblings, 0) AS n_siblings, p.other_id AS best_sibling,
               p.other_n AS best_sibling_count
        FROM counts c LEFT JOIN pairs p ON p.article_id = c.article_id AND p.place = 1"""
    ),
)
def sibling_self_join(spark, sf_dir):
    shop = retail(spark, sf_dir)
    return related.siblings(windows.date_window(shop.tx, *Q1), shop.articles)


@query(
    "variant_self_join",
    retail_sql(VARIANT_SQL + " SELECT article_id, other_id AS variant_id FROM variant"),
)
def variant_self_join(spark, sf_dir):
    shop = retail(spark, sf_dir)
    return related.variant_map(shop.tx, shop.articles, RETAIL_LAST, 90)


@query(
    "keyed_align",
    retail_sql(
        f"""SELECT p.customer_id, CAST({AGE_BIN_SQL} AS INTEGER) AS segment
            FROM population p JOIN customers c ON c.customer_id = p.customer_id"""
    ),
)
def keyed_align(spark, sf_dir):
    shop = retail(spark, sf_dir)
    return shop.population.join(popularity.age_group(shop.customers), "customer_id")


BUYERS_SQL = """
pop AS (SELECT article_id, n, row_number() OVER (ORDER BY n DESC, article_id) AS rank
        FROM (SELECT article_id, count(DISTINCT customer_id) AS n FROM tx GROUP BY 1)
        QUALIFY rank <= 12)"""


@query(
    "append_popular",
    retail_sql(BUYERS_SQL + "," + f.cut([f.fill("pop")]) + f.PREDICTIONS),
)
def append_popular(spark, sf_dir):
    shop = retail(spark, sf_dir)
    popular = combine.list_literal(
        popularity.top_k_global(popularity.distinct_buyers(shop.tx))
    )
    return shop.population.select("customer_id", ids_to_string(popular).alias("prediction"))


@query(
    "no_purchase_rows",
    retail_sql(
        f"""train AS (SELECT * FROM tx WHERE {f.window(Q1[0], Q1[1])})
        SELECT 'customer' AS kind, customer_id AS id FROM population
        WHERE customer_id NOT IN (SELECT customer_id FROM train)
        UNION ALL
        SELECT 'article' AS kind, article_id AS id FROM articles
        WHERE article_id NOT IN (SELECT article_id FROM train)"""
    ),
)
def no_purchase_rows(spark, sf_dir):
    shop = retail(spark, sf_dir)
    train = windows.date_window(shop.tx, *Q1)
    absent = profile.unmatched(shop.population, train, "customer_id")
    unsold = profile.unmatched(shop.articles, train, "article_id")
    return absent.select(F.lit("customer").alias("kind"), F.col("customer_id").alias("id")).unionByName(
        unsold.select(F.lit("article").alias("kind"), F.col("article_id").alias("id"))
    )


# --- aggregations ----------------------------------------------------------


@query(
    "distinct_buyers",
    clicks_sql("SELECT article_id, count(DISTINCT customer_id) AS n FROM tx GROUP BY 1"),
)
def distinct_buyers(spark, sf_dir):
    return popularity.distinct_buyers(clicks(spark, sf_dir).tx)


@query("article_counts", clicks_sql("SELECT article_id, count(*) AS n FROM tx GROUP BY 1"))
def article_counts(spark, sf_dir):
    return popularity.article_counts(clicks(spark, sf_dir).tx)


@query(
    "customer_article_counts",
    clicks_sql(
        """SELECT customer_id, article_id, count(*) AS n, min(t_dat) AS first_dat,
           max(t_dat) AS last_dat FROM tx GROUP BY 1, 2"""
    ),
)
def customer_article_counts(spark, sf_dir):
    return history.customer_article_counts(clicks(spark, sf_dir).tx)


@query(
    "items_per_customer",
    clicks_sql(
        """daily AS (SELECT customer_id, t_dat, article_id, count(*) AS n FROM tx GROUP BY 1, 2, 3)
        SELECT customer_id, t_dat, article_id, n,
               CAST(1 + coalesce(sum(n) OVER (PARTITION BY customer_id ORDER BY t_dat, article_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS position
        FROM daily"""
    ),
)
def items_per_customer(spark, sf_dir):
    return history.items_per_customer(clicks(spark, sf_dir).tx)


@query(
    "last_days_of_the_data",
    clicks_sql(
        """last AS (SELECT max(t_dat) AS d FROM tx)
        SELECT article_id, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, article_id) AS INTEGER) AS rank
        FROM tx, last WHERE t_dat BETWEEN d - 6 AND d GROUP BY article_id QUALIFY rank <= 12"""
    ),
)
def last_days_of_the_data(spark, sf_dir):
    """The last day comes from the data, as a scalar subquery."""
    tx = clicks(spark, sf_dir).tx
    return popularity.top_k_global(popularity.article_counts(windows.trailing_window(tx, windows.last_date(tx), 6)))


@query(
    "weekly_counts_of_the_data",
    clicks_sql(
        """last AS (SELECT max(t_dat) AS d FROM tx)
        SELECT d - CAST(floor((d - t_dat) / 7.0) AS INTEGER) * 7 AS week_end, article_id, count(*) AS n FROM tx, last GROUP BY 1, 2"""
    ),
)
def weekly_counts_of_the_data(spark, sf_dir):
    tx = clicks(spark, sf_dir).tx
    return popularity.weekly_article_counts(tx, windows.last_date(tx))


EXP_REF = W1[1] + dt.timedelta(days=790)


@query(
    "weighted_popularity_exp",
    clicks_sql(
        f"""days AS (SELECT article_id, DATE '{EXP_REF}' - t_dat - CASE WHEN CAST(article_id AS BIGINT) % 2 = 0 THEN 0 ELSE 90 END AS back
             FROM tx WHERE {f.window(W2[0], W1[1])}),
        newest AS (SELECT article_id, min(back) AS newest FROM days GROUP BY 1),
        sums AS (SELECT article_id, any_value(newest) AS newest, sum(exp(CAST(newest - back AS DOUBLE))) AS s
             FROM days JOIN newest USING (article_id) GROUP BY 1),
        scored AS (SELECT article_id, round(ln(s) - newest, 9) AS log_score FROM sums)
        SELECT article_id, round(log_score, 6) AS log_score, CAST(row_number() OVER (ORDER BY log_score DESC, article_id DESC) AS INTEGER) AS rank
        FROM scored"""
    ),
)
def weighted_popularity_exp(spark, sf_dir):
    """Articles last sold some 700 and some 800 days back, where weights are too small for a double."""
    tx = clicks(spark, sf_dir).tx
    odd = F.col("article_id").cast("long") % 2 == 1
    moved = windows.date_window(tx, W2[0], W1[1]).withColumn("t_dat", F.when(odd, F.date_add("t_dat", 90)).otherwise(F.col("t_dat")))
    top = popularity.popular_items(moved, W2[0], EXP_REF, EXP_REF, k=1_000_000, decay="exp")
    return top.select("article_id", F.round("log_score", 6).alias("log_score"), "rank")


@query(
    "weighted_popularity",
    clicks_sql(
        f.popular("pop", W2[0], W1[1], k=1_000_000) + " SELECT article_id, round(score, 6) AS score FROM pop"
    ),
)
def weighted_popularity(spark, sf_dir):
    train = windows.date_window(clicks(spark, sf_dir).tx, W2[0], W1[1])
    return popularity.weighted_popularity(train, CLICKS_REF).select(
        "article_id", F.round("score", 6).alias("score")
    )


STATS_SQL = """SELECT t_dat, customer_id, article_id, price,
  count(*) OVER (PARTITION BY article_id) AS article_count,
  min(price) OVER (PARTITION BY article_id) AS article_min_price FROM tx"""


@query("per_row_group_stats", clicks_sql(STATS_SQL))
def per_row_group_stats(spark, sf_dir):
    return popularity.with_article_stats(clicks(spark, sf_dir).tx).select(
        "t_dat", "customer_id", "article_id", "price", "article_count", "article_min_price"
    )


@query(
    "segment_article_counts",
    clicks_sql(
        CHANNEL_GROUP_SQL
        + """ SELECT g.segment, t.article_id, count(*) AS n
        FROM tx t JOIN groups g ON g.customer_id = t.customer_id GROUP BY 1, 2"""
    ),
)
def segment_article_counts(spark, sf_dir):
    shop = clicks(spark, sf_dir)
    groups = popularity.population_channel_group(shop.population, shop.tx)
    return popularity.segment_article_counts(shop.tx, groups)


@query(
    "weekly_article_counts",
    clicks_sql(
        f"SELECT {f.bucket(CLICKS_LAST, 7)} AS week_end, article_id, count(*) AS n FROM tx GROUP BY 1, 2"
    ),
)
def weekly_article_counts(spark, sf_dir):
    return popularity.weekly_article_counts(clicks(spark, sf_dir).tx, CLICKS_LAST)


@query(
    "channel_group",
    retail_sql(CHANNEL_GROUP_SQL + " SELECT customer_id, segment FROM groups"),
)
def channel_group(spark, sf_dir):
    shop = retail(spark, sf_dir)
    return popularity.population_channel_group(shop.population, shop.tx)


@query(
    "global_and_customer_max",
    clicks_sql(
        f"""SELECT customer_id, max(t_dat) AS l_dat, (SELECT max(t_dat) FROM tx) AS last_dat,
            (SELECT max(t_dat) FROM tx WHERE t_dat < DATE '{CLICKS_REF}') AS last_train_dat
            FROM tx GROUP BY 1"""
    ),
)
def global_and_customer_max(spark, sf_dir):
    tx = clicks(spark, sf_dir).tx
    train, _ = windows.temporal_split(tx, CLICKS_REF)
    return tx.groupBy("customer_id").agg(F.max("t_dat").alias("l_dat")).select(
        "customer_id",
        "l_dat",
        windows.last_date(tx).alias("last_dat"),
        windows.last_date(train).alias("last_train_dat"),
    )


@query(
    "normalised_feedback",
    clicks_sql(
        f"""train AS (SELECT * FROM tx WHERE {f.window(W2[0], W1[1])}),
        pair AS (SELECT customer_id, article_id, count(*) AS n FROM train GROUP BY 1, 2)
        SELECT customer_id, article_id, n,
          round(n::DOUBLE / (sum(n) OVER (PARTITION BY article_id) * sum(n) OVER (PARTITION BY customer_id)), 9)
            AS feedback FROM pair"""
    ),
)
def normalised_feedback_query(spark, sf_dir):
    train = windows.date_window(clicks(spark, sf_dir).tx, W2[0], W1[1])
    return normalised_feedback(train).withColumn("feedback", F.round("feedback", 9))


LAST_WEEK_SQL = """
recent AS (SELECT * FROM (SELECT *, max(t_dat) OVER (PARTITION BY customer_id) AS l_dat FROM tx)
           WHERE l_dat - t_dat <= 6),
last_week AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id
                                 ORDER BY n DESC, last_dat DESC, article_id) AS rank
    FROM (SELECT customer_id, article_id, count(*) AS n, max(t_dat) AS last_dat
          FROM recent GROUP BY 1, 2))
  WHERE rank <= 12)"""


@query(
    "concat_ids",
    clicks_sql(
        LAST_WEEK_SQL
        + """ SELECT customer_id, string_agg(article_id, ' ' ORDER BY rank) AS prediction
        FROM last_week GROUP BY 1"""
    ),
)
def concat_ids(spark, sf_dir):
    own = combine.to_lists(history.last_week_items(clicks(spark, sf_dir).tx))
    return combine.to_predictions(own)


TREND_SQL = f"""
dated AS (SELECT *, {f.bucket(CLICKS_LAST, 7)} AS week_end FROM tx),
weekly AS (SELECT week_end, article_id, count(*) AS n FROM dated GROUP BY 1, 2),
rows_q AS (
  SELECT d.*, w.n, coalesce(l.n, 0) AS n_targ, coalesce(l.n, 0)::DOUBLE / w.n AS quotient,
         greatest(1, DATE '{CLICKS_LAST}' - d.t_dat)::DOUBLE AS x
  FROM dated d JOIN weekly w ON w.week_end = d.week_end AND w.article_id = d.article_id
  LEFT JOIN weekly l ON l.week_end = DATE '{CLICKS_LAST}' AND l.article_id = d.article_id),
article_trend AS (
  SELECT article_id, CAST(round(sum(quotient)) AS BIGINT) AS score FROM rows_q GROUP BY 1),
customer_trend AS (
  SELECT * FROM (
    SELECT customer_id, article_id, min(t_dat) AS first_dat,
           round(sum(quotient * greatest(0.0::DOUBLE, 2.5e4 / sqrt(x) + 1.5e5 * exp(-0.2::DOUBLE * x) - 1e3)), 6) AS score
    FROM rows_q GROUP BY 1, 2)
  WHERE score > 0)"""


@query(
    "trend_quotient_sum",
    clicks_sql(TREND_SQL + " SELECT article_id, score FROM article_trend"),
)
def trend_quotient_sum(spark, sf_dir):
    return trend.trend_quotient_sum(clicks(spark, sf_dir).tx, CLICKS_LAST)


@query(
    "customer_article_score",
    clicks_sql(TREND_SQL + " SELECT customer_id, article_id, round(score, 3) AS score, first_dat FROM customer_trend"),
)
def customer_article_score_query(spark, sf_dir):
    return customer_article_score(clicks(spark, sf_dir).tx, CLICKS_LAST).withColumn(
        "score", F.round("score", 3)
    )


# --- rankings ---------------------------------------------------------------


@query(
    "rank_within_customer",
    clicks_sql(f.history("own", W2[0], W1[1]) + " SELECT customer_id, article_id, n, CAST(rank AS INTEGER) AS rank FROM own"),
)
def rank_within_customer(spark, sf_dir):
    return history.history_items(clicks(spark, sf_dir).tx, W2[0], W1[1])


@query(
    "rank_within_segment",
    clicks_sql(
        CHANNEL_GROUP_SQL
        + """, counts AS (SELECT g.segment, t.article_id, count(*) AS n
                FROM tx t JOIN groups g ON g.customer_id = t.customer_id GROUP BY 1, 2)
        SELECT segment, article_id, n, CAST(row_number() OVER (PARTITION BY segment ORDER BY n DESC, article_id) AS INTEGER) AS rank
        FROM counts QUALIFY rank <= 12"""
    ),
)
def rank_within_segment(spark, sf_dir):
    shop = clicks(spark, sf_dir)
    groups = popularity.population_channel_group(shop.population, shop.tx)
    counts = popularity.segment_article_counts(shop.tx, groups)
    return top_per_group(counts, ["segment"], [F.desc("n"), F.asc("article_id")], 12)


@query(
    "group_max_min_count",
    clicks_sql(
        """SELECT article_id, customer_id, t_dat, count(*) OVER (PARTITION BY article_id) AS article_count,
           min(price) OVER (PARTITION BY article_id) AS article_min_price,
           max(t_dat) OVER (PARTITION BY customer_id) AS l_dat FROM tx"""
    ),
)
def group_max_min_count(spark, sf_dir):
    tx = clicks(spark, sf_dir).tx
    latest = tx.groupBy("customer_id").agg(F.max("t_dat").alias("l_dat"))
    return join_totals(popularity.with_article_stats(tx), latest, ["customer_id"]).select(
        "article_id", "customer_id", "t_dat", "article_count", "article_min_price", "l_dat"
    )


@query(
    "keep_latest",
    clicks_sql("SELECT customer_id, article_id, max(t_dat) AS t_dat FROM tx GROUP BY 1, 2"),
)
def keep_latest(spark, sf_dir):
    return history.keep_latest(clicks(spark, sf_dir).tx)


@query(
    "top_k_global",
    clicks_sql(
        """SELECT article_id, n, CAST(row_number() OVER (ORDER BY n DESC, article_id) AS INTEGER) AS rank
           FROM (SELECT article_id, count(*) AS n FROM tx GROUP BY 1) QUALIFY rank <= 12"""
    ),
)
def top_k_global(spark, sf_dir):
    return popularity.top_k_global(popularity.article_counts(clicks(spark, sf_dir).tx))


@query(
    "popular_order",
    clicks_sql(f.popular("pop", W2[0], W1[1]) + " SELECT article_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM pop"),
)
def popular_order(spark, sf_dir):
    return recommend.popular_items(clicks(spark, sf_dir).tx, W2[0], W1[1]).withColumn(
        "score", F.round("score", 6)
    )


@query(
    "n_largest",
    clicks_sql(
        TREND_SQL
        + """ SELECT customer_id, article_id, CAST(row_number() OVER (PARTITION BY customer_id
             ORDER BY score DESC, first_dat, article_id) AS INTEGER) AS rank
        FROM customer_trend QUALIFY rank <= 12"""
    ),
)
def n_largest(spark, sf_dir):
    return trend.trend_items(clicks(spark, sf_dir).tx, CLICKS_LAST).drop("score")


@query(
    "frequent_first",
    clicks_sql(f.history("own", W4[0], W1[1], 20) + " SELECT customer_id, article_id, CAST(rank AS INTEGER) AS rank FROM own"),
)
def frequent_first(spark, sf_dir):
    return history.history_items(clicks(spark, sf_dir).tx, W4[0], W1[1], 20).drop("n")


@query(
    "frequent_then_recent",
    clicks_sql(
        LAST_WEEK_SQL
        + " SELECT customer_id, article_id, n, last_dat, CAST(rank AS INTEGER) AS rank FROM last_week"
    ),
)
def frequent_then_recent(spark, sf_dir):
    return history.last_week_items(clicks(spark, sf_dir).tx)


RECENT_FIRST_SQL = """
latest AS (SELECT customer_id, article_id, max(t_dat) AS last_dat FROM (
             SELECT *, max(t_dat) OVER (PARTITION BY customer_id) AS l_dat FROM tx)
           WHERE l_dat - t_dat < 14 GROUP BY 1, 2),
bought AS (SELECT *, row_number() OVER (PARTITION BY customer_id
                                        ORDER BY last_dat DESC, article_id) AS rank FROM latest)"""


@query(
    "recent_first",
    clicks_sql(RECENT_FIRST_SQL + " SELECT customer_id, article_id, last_dat, CAST(rank AS INTEGER) AS rank FROM bought WHERE rank <= 12"),
)
def recent_first(spark, sf_dir):
    return history.last_purchase_items(clicks(spark, sf_dir).tx, 14, k=12)


# --- set operations ----------------------------------------------------------


@query(
    "union_windows",
    clicks_sql(
        f"""SELECT t_dat, customer_id, article_id, 1 AS window_no FROM tx WHERE {f.window(*W1)}
            UNION ALL
            SELECT t_dat, customer_id, article_id, 2 AS window_no FROM tx WHERE {f.window(*W2)}"""
    ),
)
def union_windows(spark, sf_dir):
    tx = clicks(spark, sf_dir).tx
    return windows.date_window(tx, W2[0], W1[1]).select(
        "t_dat", "customer_id", "article_id", window_number("t_dat", [W1, W2]).alias("window_no")
    )


@query(
    "distinct_rows",
    clicks_sql("SELECT DISTINCT customer_id, article_id FROM tx"),
)
def distinct_rows(spark, sf_dir):
    return clicks(spark, sf_dir).tx.select("customer_id", "article_id").dropDuplicates()


OVERLAP_SQL = f"""
train AS (SELECT DISTINCT customer_id FROM tx WHERE {f.window(W2[0], W1[1])}),
valid AS (SELECT DISTINCT customer_id FROM tx WHERE {f.window(CLICKS_REF, CLICKS_END)})
SELECT count(*) FILTER (WHERE v.customer_id IS NULL) AS left_only,
       count(*) FILTER (WHERE t.customer_id IS NOT NULL AND v.customer_id IS NOT NULL) AS both,
       count(*) FILTER (WHERE t.customer_id IS NULL) AS right_only
FROM train t FULL JOIN valid v ON v.customer_id = t.customer_id"""


@query("key_overlap", clicks_sql(OVERLAP_SQL))
def key_overlap(spark, sf_dir):
    tx = clicks(spark, sf_dir).tx
    return profile.key_overlap(
        windows.date_window(tx, W2[0], W1[1]),
        windows.date_window(tx, CLICKS_REF, CLICKS_END),
        "customer_id",
    )


# --- lists ---------------------------------------------------------------------


def _stack_parts(count: int = 4):
    return [f.own(f"h{i}", i) for i in range(1, count + 1)]


STACK_SQL = ",".join(f.history(f"h{i}", *w) for i, w in enumerate(CLICKS_WINDOWS[:4], start=1))


@query(
    "list_stack",
    clicks_sql(STACK_SQL + "," + f.cut(_stack_parts()) + f.PREDICTIONS),
)
def list_stack(spark, sf_dir):
    own = combine.to_lists(history.stacked_history(clicks(spark, sf_dir).tx, CLICKS_WINDOWS[:4]))
    return combine.to_predictions(own)


BLEND_SQL = (
    RECENT_FIRST_SQL
    + ","
    + f.history("own", W2[0], W1[1])
    + """,
parts AS (
  SELECT customer_id, article_id, 0 AS list_no, rank, 100.0::DOUBLE / rank AS part FROM bought
  UNION ALL
  SELECT customer_id, article_id, 1 AS list_no, rank, 10.0::DOUBLE / rank AS part FROM own),
scores AS (SELECT customer_id, article_id, round(sum(part), 9) AS score,
                  min(list_no * 1000000 + rank) AS first_place FROM parts GROUP BY 1, 2),
blended AS (
  SELECT customer_id, article_id, score,
         row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, first_place) AS rank
  FROM scores)"""
)


def _blend(spark, sf_dir, k):
    tx = clicks(spark, sf_dir).tx
    return combine.blend(
        [history.last_purchase_items(tx, 14), history.history_items(tx, W2[0], W1[1])],
        [100, 10],
        k,
    )


@query(
    "blend",
    clicks_sql(
        BLEND_SQL
        + " SELECT customer_id, article_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM blended WHERE rank <= 12"
    ),
)
def blend(spark, sf_dir):
    return _blend(spark, sf_dir, 12).withColumn("score", F.round("score", 6))


@query(
    "prune",
    clicks_sql(
        BLEND_SQL
        + f""", kept AS (
          SELECT * FROM blended WHERE rank <= 32 AND article_id IN (
            SELECT article_id FROM tx WHERE t_dat BETWEEN DATE '{CLICKS_LAST}' - 1 AND DATE '{CLICKS_LAST}'))
        SELECT customer_id, article_id,
               CAST(row_number() OVER (PARTITION BY customer_id ORDER BY rank) AS INTEGER) AS rank
        FROM kept QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY kept.rank) <= 12"""
    ),
)
def prune(spark, sf_dir):
    tx = clicks(spark, sf_dir).tx
    return combine.prune(_blend(spark, sf_dir, 32), windows.sold_articles(tx, CLICKS_LAST, 1))


@query(
    "map_list",
    clicks_sql(
        RECENT_FIRST_SQL
        + """, mapping AS (SELECT article_id, lpad(CAST(CAST(article_id AS BIGINT) + 1 AS VARCHAR), 10, '0') AS image
                FROM (SELECT DISTINCT article_id FROM tx WHERE sales_channel_id = 1))
        SELECT b.customer_id, m.image AS article_id,
               row_number() OVER (PARTITION BY b.customer_id ORDER BY b.rank) AS rank
        FROM bought b JOIN mapping m ON m.article_id = b.article_id"""
    ),
)
def map_list(spark, sf_dir):
    tx = clicks(spark, sf_dir).tx
    mapping = (
        windows.channel_filter(tx, 1)
        .select("article_id")
        .distinct()
        .withColumn("image", keys.article_label(keys.article_key("article_id") + 1))
    )
    bought = history.last_purchase_items(tx, 14).select("customer_id", "rank", "article_id")
    return related.map_list(bought, mapping, "image")


@query(
    "list_length_hist",
    clicks_sql(
        f.history("own", W2[0], W1[1])
        + """ SELECT length, count(*) AS n FROM (
          SELECT p.customer_id, count(o.article_id) AS length FROM population p
          LEFT JOIN own o ON o.customer_id = p.customer_id GROUP BY 1) GROUP BY 1"""
    ),
)
def list_length_hist(spark, sf_dir):
    shop = clicks(spark, sf_dir)
    own = combine.to_lists(history.history_items(shop.tx, W2[0], W1[1]))
    lists = shop.population.join(own, "customer_id", "left").select(
        "customer_id", or_empty("items").alias("items")
    )
    return combine.list_length_hist(lists)
