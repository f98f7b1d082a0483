"""Weekly trend: how an article sells now against the week it was bought in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.dates import DateLike, as_date, day_diff, mixed_days, week_bucket
from basketry.functions.keys import LIST_LENGTH
from basketry.operators.popularity import weekly_article_counts
from basketry.operators.skew import join_totals, top_per_group

SCORE_DIGITS = 6


def trend_quotient_sum(tx: DataFrame, last: DateLike, days: int = 7) -> DataFrame:
    """Sum over an article's rows of (last week's count / count in the row's week).

    Every week with a sale adds exactly last week's count, so the sum is that
    count times the number of weeks sold: whole numbers, one row per article.
    """
    weekly = weekly_article_counts(tx, last, days)
    final = F.when(F.col("week_end") == as_date(last), F.col("n"))
    return weekly.groupBy("article_id").agg(
        (F.coalesce(F.max(final), F.lit(0)) * F.count(F.lit(1))).cast("bigint").alias("score")
    )


def trend_popular(
    tx: DataFrame, last: DateLike, k: int = LIST_LENGTH, days: int = 7
) -> DataFrame:
    """Articles with the largest quotient sums, ties by ascending id."""
    return (
        trend_quotient_sum(tx, last, days)
        .orderBy(F.desc("score"), F.asc("article_id"))
        .limit(k)
    )


def customer_article_score(tx: DataFrame, last: DateLike, days: int = 7) -> DataFrame:
    """Sum of quotient times mixed decay per (customer, article), positive scores only.

    Only articles sold in the last week can score, so the others leave before the
    joins.
    """
    weekly = weekly_article_counts(tx, last, days)
    target = weekly.where(F.col("week_end") == as_date(last)).select(
        "article_id", F.col("n").alias("n_targ")
    )
    daily = tx.groupBy("customer_id", "article_id", "t_dat").agg(
        F.count(F.lit(1)).alias("units")
    )
    alive = join_totals(daily, target, ["article_id"]).withColumn(
        "week_end", week_bucket("t_dat", last, days)
    )
    value = (
        F.col("units") * (F.col("n_targ") / F.col("n")) * mixed_days(day_diff(last, "t_dat"))
    )
    return (
        join_totals(alive, weekly, ["week_end", "article_id"])
        .groupBy("customer_id", "article_id")
        .agg(
            F.round(F.sum(value), SCORE_DIGITS).alias("score"),
            F.min("t_dat").alias("first_dat"),
        )
        .where(F.col("score") > 0)
    )


def trend_items(
    tx: DataFrame, last: DateLike, k: int = LIST_LENGTH, days: int = 7
) -> DataFrame:
    """A customer's best scores, ties by first purchase."""
    order = [F.desc("score"), F.asc("first_dat"), F.asc("article_id")]
    return top_per_group(
        customer_article_score(tx, last, days), ["customer_id"], order, k
    ).select("customer_id", "rank", "article_id", "score")
