"""Row selection by date, channel and recency."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.dates import DateLike, as_date, day_diff, in_window, window_number
from basketry.operators.skew import join_keys, join_totals

WindowList = list[tuple[DateLike, DateLike]]


def last_date(tx: DataFrame) -> Column:
    """Last purchase date as a scalar subquery: computed once, one row."""
    return tx.agg(F.max("t_dat")).scalar()


def back_windows(ref: dt.date | str, days: int, count: int) -> WindowList:
    """``count`` neighbouring windows of ``days`` days that end before ``ref``, newest first."""
    ref = ref if isinstance(ref, dt.date) else dt.date.fromisoformat(ref)
    step = dt.timedelta(days=days)
    return [(ref - step * (i + 1), ref - step * i) for i in range(count)]


def date_window(tx: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    return tx.where(in_window("t_dat", start, end))


def since(tx: DataFrame, start: DateLike) -> DataFrame:
    return tx.where(F.col("t_dat") >= as_date(start))


def numbered_windows(tx: DataFrame, windows: WindowList) -> DataFrame:
    """Rows of any window with ``window_no`` (1 = first in the list), in one scan."""
    inside = None
    for start, end in windows:
        hit = in_window("t_dat", start, end)
        inside = hit if inside is None else inside | hit
    return tx.where(inside).withColumn("window_no", window_number("t_dat", windows))


def trailing_window(tx: DataFrame, last: DateLike, days: int) -> DataFrame:
    """Rows from ``last - days`` to ``last``, both included."""
    last = as_date(last)
    return tx.where(F.col("t_dat").between(F.date_sub(last, days), last))


def customer_recency(tx: DataFrame, within_days: int) -> DataFrame:
    """Rows at most ``within_days`` days before the customer's own last purchase.

    Adds ``l_dat``, the customer's last date.
    """
    latest = tx.groupBy("customer_id").agg(F.max("t_dat").alias("l_dat"))
    return join_totals(tx, latest, ["customer_id"]).where(
        day_diff(F.col("l_dat"), "t_dat") <= within_days
    )


def channel_filter(tx: DataFrame, channel: int) -> DataFrame:
    return tx.where(F.col("sales_channel_id") == channel)


def sold_articles(tx: DataFrame, last: DateLike, days: int) -> DataFrame:
    """Articles sold in the trailing window."""
    return trailing_window(tx, last, days).select("article_id").distinct()


def sold_recently(rows: DataFrame, tx: DataFrame, last: DateLike, days: int) -> DataFrame:
    return join_keys(rows, trailing_window(tx, last, days), ["article_id"])


def temporal_split(tx: DataFrame, cut: DateLike) -> tuple[DataFrame, DataFrame]:
    """Rows before the cut date, and rows on or after it."""
    return tx.where(F.col("t_dat") < as_date(cut)), since(tx, cut)
