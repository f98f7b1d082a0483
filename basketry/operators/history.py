"""What a customer bought, as ranked long tables ``(customer_id, rank, article_id)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.dates import DateLike
from basketry.functions.keys import LIST_LENGTH
from basketry.operators.skew import join_totals, numbered, top_per_group
from basketry.operators.windows import WindowList, date_window, numbered_windows


def customer_article_counts(tx: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows ``n``, first date and last date per (customer, article)."""
    return tx.groupBy(*(by or []), "customer_id", "article_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("t_dat").alias("first_dat"),
        F.max("t_dat").alias("last_dat"),
    )


def frequent_first() -> list[Column]:
    """Count descending, then first purchase, then id."""
    return [F.desc("n"), F.asc("first_dat"), F.asc("article_id")]


def frequent_then_recent() -> list[Column]:
    return [F.desc("n"), F.desc("last_dat"), F.asc("article_id")]


def recent_first() -> list[Column]:
    return [F.desc("last_dat"), F.asc("article_id")]


def history_items(
    tx: DataFrame, start: DateLike, end: DateLike, k: int = LIST_LENGTH
) -> DataFrame:
    """A customer's articles in a window, most often bought first."""
    counts = customer_article_counts(date_window(tx, start, end))
    return top_per_group(counts, ["customer_id"], frequent_first(), k).select(
        "customer_id", "rank", "article_id", "n"
    )


def stacked_history(
    tx: DataFrame, windows: WindowList, k: int = LIST_LENGTH, dedup: bool = False
) -> DataFrame:
    """Articles of several windows, newest window first, cut at ``k`` in all.

    One pass over the rows and one ranking per customer serve every window. With
    ``dedup`` an article counts in the first window that has it.
    """
    counts = customer_article_counts(numbered_windows(tx, windows), ["window_no"])
    if dedup:
        first = F.struct("window_no", (-F.col("n")).alias("less"), "first_dat")
        counts = counts.groupBy("customer_id", "article_id").agg(F.min(first).alias("f")).select(
            "customer_id",
            "article_id",
            F.col("f.window_no").alias("window_no"),
            (-F.col("f.less")).alias("n"),
            F.col("f.first_dat").alias("first_dat"),
        )
    order = [F.asc("window_no"), *frequent_first()]
    return top_per_group(counts, ["customer_id"], order, k).select(
        "customer_id", "rank", "window_no", "article_id"
    )


def items_per_customer(tx: DataFrame) -> DataFrame:
    """Every customer's purchases in date order, whole lists in long form.

    Repeated units stay one row with their number ``n``; ``position`` is the
    place of the first of them in the customer's list.
    """
    daily = tx.groupBy("customer_id", "t_dat", "article_id").agg(F.count(F.lit(1)).alias("n"))
    return numbered(daily, ["customer_id"], [F.asc("t_dat"), F.asc("article_id")], "position", weight="n")


def last_purchase_items(
    tx: DataFrame, days: int = 14, k: int | None = None
) -> DataFrame:
    """Articles bought less than ``days`` days before the customer's own last date, newest first.

    Only the last date of each (customer, article) matters, so the rows are
    reduced to that first and the customer's last date comes from the result.
    Without ``k`` the lists are whole, whatever their length.
    """
    pairs = tx.groupBy("customer_id", "article_id").agg(F.max("t_dat").alias("last_dat"))
    latest = _recent(pairs, "last_dat", days - 1)
    if k is not None:
        return top_per_group(latest, ["customer_id"], recent_first(), k)
    return numbered(latest, ["customer_id"], recent_first())


def _recent(rows: DataFrame, date: str, within_days: int) -> DataFrame:
    """Rows within the last days of each customer, from an aggregate that has all of the dates."""
    last = rows.groupBy("customer_id").agg(F.max(date).alias("_last"))
    return (
        join_totals(rows, last, ["customer_id"])
        .where(F.datediff("_last", date) <= within_days)
        .drop("_last")
    )


def last_week_items(
    tx: DataFrame, within_days: int = 6, k: int = LIST_LENGTH
) -> DataFrame:
    """Articles of the customer's own last week, most often and then most recently bought first."""
    daily = tx.groupBy("customer_id", "article_id", "t_dat").agg(F.count(F.lit(1)).alias("n"))
    counts = (
        _recent(daily, "t_dat", within_days)
        .groupBy("customer_id", "article_id")
        .agg(F.sum("n").alias("n"), F.max("t_dat").alias("last_dat"))
    )
    return top_per_group(counts, ["customer_id"], frequent_then_recent(), k).select(
        "customer_id", "rank", "article_id", "n", "last_dat"
    )


def keep_latest(tx: DataFrame) -> DataFrame:
    """Last date per (customer, article): the newest row of each pair."""
    return tx.groupBy("customer_id", "article_id").agg(F.max("t_dat").alias("t_dat"))
