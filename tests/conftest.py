from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def purchases(spark):
    """Build a purchase table from (day, customer, article[, price[, channel]]) rows."""

    def build(rows):
        full = []
        for day, customer, article, *rest in rows:
            price = float(rest[0]) if rest else 1.0
            channel = rest[1] if len(rest) > 1 else 1
            date = day if isinstance(day, dt.date) else dt.date.fromisoformat(day)
            full.append((date, customer, article, price, channel))
        return spark.createDataFrame(
            full,
            "t_dat date, customer_id string, article_id string, price double, sales_channel_id int",
        )

    return build
