"""Counts and popularity of articles, overall and by segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.dates import DECAYS, DateLike, as_date, day_diff, week_bucket
from basketry.functions.keys import LIST_LENGTH, bin_column
from basketry.operators.skew import join_totals, top_per_group
from basketry.operators.windows import date_window, trailing_window

# Right-closed age bins.
AGE_EDGES = [-1, 19, 29, 39, 49, 59, 69, 119]

# Sums of float weights differ in the last digits with the order of the rows, so
# scores are rounded before they are ranked.
SCORE_DIGITS = 9


def distinct_buyers(tx: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct customers per article."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return tx.groupBy("article_id").agg(count("customer_id").cast("bigint").alias("n"))


def article_counts(tx: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows per article, optionally within the columns ``by``."""
    return tx.groupBy(*(by or []), "article_id").agg(F.count(F.lit(1)).alias("n"))


def article_stats(tx: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows and lowest price per article."""
    return tx.groupBy(*(by or []), "article_id").agg(
        F.count(F.lit(1)).alias("article_count"), F.min("price").alias("article_min_price")
    )


def with_article_stats(tx: DataFrame) -> DataFrame:
    """Every row with the count and lowest price of its article."""
    return join_totals(tx, article_stats(tx), ["article_id"])


def weighted_popularity(
    tx: DataFrame,
    ref: DateLike,
    decay: str = "inverse",
    by: list[str] | None = None,
) -> DataFrame:
    """Sum of time-decay weights per article, as ``score``; ``ref`` lies after the last row.

    Rows are counted per article and day first, so that the float sum has one
    term per day. Exponential weights get smaller than any double, so those
    articles also get ``log_score``, the natural logarithm of the sum: weights are
    summed relative to the article's own newest day. Order by it; ``score`` is 0
    where the sum is too small for a double.
    """
    by = by or []
    daily = tx.groupBy(*by, "article_id", "t_dat").agg(F.count(F.lit(1)).alias("n"))
    if decay != "exp":
        weight = F.col("n") * DECAYS[decay](day_diff(ref, "t_dat"))
        return daily.groupBy(*by, "article_id").agg(F.round(F.sum(weight), SCORE_DIGITS).alias("score"))
    day = F.struct(day_diff(ref, "t_dat").alias("days"), "n")
    days = daily.groupBy(*by, "article_id").agg(F.min(day_diff(ref, "t_dat")).alias("_newest"), F.collect_list(day).alias("_days"))
    relative = F.aggregate(  # oldest first, so that the sum has one order
        F.reverse(F.array_sort("_days")), F.lit(0.0), lambda total, d: total + d["n"] * F.exp((F.col("_newest") - d["days"]).cast("double"))
    )
    log_score = F.round(F.log(relative) - F.col("_newest"), SCORE_DIGITS)
    return days.select(*by, "article_id", F.exp(log_score).alias("score"), log_score.alias("log_score"))


def popular_order(decay: str = "inverse") -> list[Column]:
    """Score descending, ties by descending id."""
    return [F.desc("log_score" if decay == "exp" else "score"), F.desc("article_id")]


def top_k_global(counts: DataFrame, k: int = LIST_LENGTH) -> DataFrame:
    """The ``k`` largest counts, ties by ascending id, with their rank."""
    top = counts.orderBy(F.desc("n"), F.asc("article_id")).limit(k)
    return ranked(top, [F.desc("n"), F.asc("article_id")])


def ranked(short: DataFrame, order: list[Column]) -> DataFrame:
    """Rank column for a table that a limit has already cut to a few rows."""
    return short.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def popular_items(
    tx: DataFrame,
    start: DateLike,
    end: DateLike,
    ref: DateLike | None = None,
    k: int = LIST_LENGTH,
    by: str | None = None,
    decay: str = "inverse",
) -> DataFrame:
    """Top ``k`` articles by decayed popularity in a window: ``[by,] rank, article_id, score``.

    With ``decay="exp"`` there is ``log_score`` too, see ``weighted_popularity``.
    """
    window = date_window(tx, start, end)
    ref = end if ref is None else ref
    if by:
        scores = weighted_popularity(window, ref, decay, [by])
        return top_per_group(scores, [by], popular_order(decay), k)
    scores = weighted_popularity(window, ref, decay)
    return ranked(scores.orderBy(*popular_order(decay)).limit(k), popular_order(decay))


def channel_group(tx: DataFrame) -> DataFrame:
    """Mean sales channel per customer, rounded half to even."""
    return tx.groupBy("customer_id").agg(
        F.bround(F.avg("sales_channel_id"), 0).cast("int").alias("segment")
    )


def population_channel_group(population: DataFrame, tx: DataFrame) -> DataFrame:
    """Channel group of everyone in the population; 1 for customers without rows."""
    return population.join(channel_group(tx), "customer_id", "left").select(
        "customer_id", F.coalesce("segment", F.lit(1)).alias("segment")
    )


def age_group(
    customers: DataFrame, edges: list[int] = AGE_EDGES, missing_bin: int | None = 0
) -> DataFrame:
    return customers.select(
        "customer_id", bin_column("age", edges, missing_bin).cast("int").alias("segment")
    )


def segment_article_counts(tx: DataFrame, segments: DataFrame) -> DataFrame:
    """Rows per (segment, article).

    Rows are counted per (customer, article) before the join, so that a hot
    customer joins with at most one row per article.
    """
    counts = tx.groupBy("customer_id", "article_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        join_totals(counts, segments, ["customer_id"])
        .groupBy("segment", "article_id")
        .agg(F.sum("n").alias("n"))
    )


def segment_popular(
    tx: DataFrame,
    segments: DataFrame,
    last: DateLike,
    days: int = 4,
    k: int = LIST_LENGTH,
) -> DataFrame:
    """Top ``k`` articles of each segment in the trailing window: ``segment, rank, article_id, n``."""
    counts = segment_article_counts(trailing_window(tx, last, days), segments)
    return top_per_group(counts, ["segment"], [F.desc("n"), F.asc("article_id")], k)


def weekly_article_counts(tx: DataFrame, last: DateLike, days: int = 7) -> DataFrame:
    """Rows per (bucket end, article)."""
    return (
        tx.groupBy(week_bucket("t_dat", last, days).alias("week_end"), "article_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def weekly_of_daily(daily: DataFrame, last: DateLike, days: int = 7) -> DataFrame:
    """``weekly_article_counts`` from counts per day, such as ``update_daily_counts`` keeps."""
    return daily.groupBy(week_bucket("t_dat", last, days).alias("week_end"), "article_id").agg(F.sum("n").alias("n"))


def with_weekly_counts(tx: DataFrame, last: DateLike, days: int = 7) -> DataFrame:
    """Every row with ``week_end``, the count ``n`` of its week and the last week's ``n_targ``."""
    weekly = weekly_article_counts(tx, last, days)
    target = weekly.where(F.col("week_end") == as_date(last)).select(
        "article_id", F.col("n").alias("n_targ")
    )
    # The two small tables first, so that the rows are shuffled once.
    counts = join_totals(weekly, target, ["article_id"], "left").withColumn(
        "n_targ", F.coalesce("n_targ", F.lit(0).cast("bigint"))
    )
    return join_totals(
        tx.withColumn("week_end", week_bucket("t_dat", last, days)),
        counts,
        ["week_end", "article_id"],
    )
