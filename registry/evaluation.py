"""Scores of predicted lists on a held-out period."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry.functions.lists import or_empty
from basketry.operators import combine, evaluate, factor, history, popularity, windows
from basketry.plans import recommend
from registry import fragments as f
from registry.base import query
from registry.fixtures import (
    CLICKS_END,
    CLICKS_REF,
    CLICKS_WINDOWS,
    RETAIL_END,
    RETAIL_REF,
    RETAIL_WINDOWS,
    clicks,
    clicks_sql,
    retail,
    retail_sql,
)
from registry.recommenders import SMALL_FACTORS, SMALL_GRID
from registry.relational import CHANNEL_GROUP_SQL

W1, W2, W3, W4, W5 = CLICKS_WINDOWS
Q1, Q2, Q3, Q4, Q5 = RETAIL_WINDOWS

VALID_SQL = f"SELECT customer_id, article_id FROM tx WHERE {f.window(CLICKS_REF, CLICKS_END)}"
LISTS_SQL = ",".join(
    [
        f.history("own", W2[0], W1[1]),
        f.popular("pop", W2[0], W1[1]),
        f.cut([f.own("own"), f.fill("pop")]),
    ]
)


def _clicks_lists(spark, sf_dir):
    shop = clicks(spark, sf_dir)
    lists = recommend.history_fill(shop.tx, shop.population, W2[0], W1[1])
    return lists, windows.date_window(shop.tx, CLICKS_REF, CLICKS_END)


@query(
    "ap_at_k",
    clicks_sql(LISTS_SQL + "," + f.average_precision(VALID_SQL) + " SELECT customer_id, round(ap, 6) AS ap FROM ap"),
)
def ap_at_k(spark, sf_dir):
    lists, valid = _clicks_lists(spark, sf_dir)
    return evaluate.ap_at_k(valid, lists).withColumn("ap", F.round("ap", 6))


def _map_sql(k):
    return clicks_sql(
        LISTS_SQL
        + ","
        + f.average_precision(VALID_SQL, k=k)
        + " SELECT round(avg(ap), 6) AS map, count(*) AS customers FROM ap"
    )


@query("map_at_k", _map_sql(12))
def map_at_k(spark, sf_dir):
    lists, valid = _clicks_lists(spark, sf_dir)
    return evaluate.map_at_k(valid, lists)


@query("map_at_10", _map_sql(10))
def map_at_10(spark, sf_dir):
    lists, valid = _clicks_lists(spark, sf_dir)
    return evaluate.map_at_k(valid, lists, k=10)


@query(
    "temporal_split",
    clicks_sql(
        f"""SELECT CASE WHEN t_dat < DATE '{CLICKS_REF}' THEN 'train' ELSE 'valid' END AS part,
            count(*) AS n, min(t_dat) AS first_dat, max(t_dat) AS last_dat FROM tx GROUP BY 1"""
    ),
)
def temporal_split(spark, sf_dir):
    train, valid = windows.temporal_split(clicks(spark, sf_dir).tx, CLICKS_REF)

    def summary(part, name):
        return part.agg(
            F.count(F.lit(1)).alias("n"),
            F.min("t_dat").alias("first_dat"),
            F.max("t_dat").alias("last_dat"),
        ).withColumn("part", F.lit(name))

    return summary(train, "train").unionByName(summary(valid, "valid"))


RETAIL_VALID_SQL = f"SELECT customer_id, article_id FROM tx WHERE {f.window(RETAIL_REF, RETAIL_END)}"
RETAIL_LISTS_SQL = ",".join(
    [
        f.history("own", Q2[0], Q1[1]),
        f.popular("pop", Q2[0], Q1[1]),
        f.cut([f.own("own"), f.fill("pop")]),
    ]
)


@query(
    "map_by_group",
    retail_sql(
        ",".join([CHANNEL_GROUP_SQL, RETAIL_LISTS_SQL, f.average_precision(RETAIL_VALID_SQL)])
        + """ SELECT 'All' AS segment, round(avg(ap), 6) AS map, count(*) AS customers FROM ap
        UNION ALL
        SELECT CAST(g.segment AS VARCHAR) AS segment, round(avg(a.ap), 6) AS map, count(*) AS customers
        FROM ap a JOIN groups g ON g.customer_id = a.customer_id GROUP BY 1"""
    ),
)
def map_by_group(spark, sf_dir):
    shop = retail(spark, sf_dir)
    lists = recommend.history_fill(shop.tx, shop.population, Q2[0], Q1[1])
    valid = windows.date_window(shop.tx, RETAIL_REF, RETAIL_END)
    groups = popularity.population_channel_group(shop.population, shop.tx)
    return evaluate.map_by_group(valid, lists, groups)


@query(
    "fill_rate",
    clicks_sql(
        f.history("own", W2[0], W1[1])
        + """, lengths AS (SELECT p.customer_id, count(o.article_id) AS length FROM population p
                LEFT JOIN own o ON o.customer_id = p.customer_id GROUP BY 1)
        SELECT round(round(avg(least(length, 12) / 12.0::DOUBLE), 6) * 100, 4) AS fill,
               count(*) AS customers FROM lengths"""
    ),
)
def fill_rate(spark, sf_dir):
    shop = clicks(spark, sf_dir)
    own = combine.to_lists(history.history_items(shop.tx, W2[0], W1[1]))
    lists = shop.population.join(own, "customer_id", "left").select(
        "customer_id", or_empty("items").alias("items")
    )
    return evaluate.fill_rate(lists)


SWEEP = [(W1[0], W1[1]), (W2[0], W1[1]), (W3[0], W1[1]), (W4[0], W1[1])]


def _sweep_sql() -> str:
    branches = []
    for number, (start, end) in enumerate(SWEEP, start=1):
        inner = clicks_sql(
            ",".join(
                [
                    f.history("own", start, end),
                    f.popular("pop", start, end, CLICKS_REF),
                    f.cut([f.own("own"), f.fill("pop")]),
                    f.average_precision(VALID_SQL),
                ]
            )
            + f" SELECT {number} AS window_no, round(avg(ap), 6) AS map, count(*) AS customers FROM ap"
        )
        branches.append(f"SELECT * FROM ({inner})")
    return "\nUNION ALL\n".join(branches)


@query("window_sweep", _sweep_sql())
def window_sweep(spark, sf_dir):
    tx = clicks(spark, sf_dir).tx
    valid = windows.date_window(tx, CLICKS_REF, CLICKS_END)
    return evaluate.window_sweep(tx, valid, SWEEP, CLICKS_REF)


@query("als_validation")
def als_validation(spark, sf_dir):
    return factor.als_validation(clicks(spark, sf_dir).tx, CLICKS_REF, SMALL_FACTORS)


@query("grid_search")
def grid_search(spark, sf_dir):
    return factor.grid_search(clicks(spark, sf_dir).tx, CLICKS_REF, SMALL_GRID)


@query(
    "als_validation_properties",
    clicks_sql(f"SELECT count(DISTINCT customer_id) AS customers, TRUE AS in_range FROM tx WHERE t_dat >= DATE '{CLICKS_REF}'"),
)
def als_validation_properties(spark, sf_dir):
    found = factor.als_validation(clicks(spark, sf_dir).tx, CLICKS_REF, SMALL_FACTORS)
    return found.select("customers", F.col("map").between(0, 1).alias("in_range"))


@query(
    "grid_search_properties",
    "SELECT unnest([8, 16, 16]) AS factors, unnest([3, 3, 8]) AS iterations, 1 AS n_best, TRUE AS best_is_largest FROM (SELECT count(*) FROM events)",
)
def grid_search_properties(spark, sf_dir):
    """All settings of the grid, one best, and that it has the largest score."""
    grid = factor.grid_search(clicks(spark, sf_dir).tx, CLICKS_REF, SMALL_GRID)
    total = grid.agg(F.sum(F.col("best").cast("int")).cast("int").alias("n_best"), F.max("map").alias("top"), F.max(F.when(F.col("best"), F.col("map"))).alias("of_best"))
    return grid.select(
        "factors",
        "iterations",
        total.select("n_best").scalar().alias("n_best"),
        total.select(F.col("top") == F.col("of_best")).scalar().alias("best_is_largest"),
    )
