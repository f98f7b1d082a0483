"""Purchases with all attributes of their customer and article."""

from __future__ import annotations

from pyspark.sql import DataFrame

from basketry.operators.skew import join_totals


def star_join(tx: DataFrame, customers: DataFrame, articles: DataFrame) -> DataFrame:
    """Every purchase with every column of both tables, nulls where a key is unknown.

    Both tables have one row for each key. A customer or article that holds much
    of the purchases is split over tasks.
    """
    rows = join_totals(tx, customers, ["customer_id"], "left")
    return join_totals(rows, articles, ["article_id"], "left")
