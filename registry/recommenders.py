"""Candidate tables and recommenders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from basketry.operators import combine, factor, history, popularity, related, windows
from basketry.plans import recommend
from registry import fragments as f
from registry.base import query
from registry.fixtures import (
    CLICKS_LAST,
    CLICKS_WINDOWS,
    RETAIL_DAYS,
    RETAIL_LAST,
    RETAIL_REF,
    RETAIL_STRETCH,
    RETAIL_WINDOWS,
    clicks,
    clicks_sql,
    retail,
    retail_sql,
)
from registry.relational import (
    BUYERS_SQL,
    CHANNEL_GROUP_SQL,
    LAST_WEEK_SQL,
    STACK_SQL,
    TREND_SQL,
)
from registry.scalar import AGE_BIN_SQL

W1, W2, W3, W4, W5 = CLICKS_WINDOWS
Q1, Q2, Q3, Q4, Q5 = RETAIL_WINDOWS

# Settings of the factor models on the small tables.
SMALL_FACTORS = factor.FactorSettings(rank=16, iterations=5)
SMALL_GRID = [
    factor.FactorSettings(rank=8, iterations=3),
    factor.FactorSettings(rank=16, iterations=3),
    factor.FactorSettings(rank=16, iterations=8),
]
SMALL_RERANK = factor.FactorSettings(rank=16, iterations=8, regularization=0.2)


# --- candidates ----------------------------------------------------------------


@query(
    "popular_items",
    retail_sql(
        ",".join(
            f.popular(f"pop{c}", Q2[0], Q1[1], where=f"sales_channel_id = {c}") for c in (1, 2)
        )
        + """ SELECT 1 AS sales_channel_id, article_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM pop1
        UNION ALL SELECT 2 AS sales_channel_id, article_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM pop2"""
    ),
)
def popular_items(spark, sf_dir):
    tx = retail(spark, sf_dir).tx
    return popularity.popular_items(tx, Q2[0], Q1[1], by="sales_channel_id").withColumn(
        "score", F.round("score", 6)
    )


@query(
    "history_items",
    retail_sql(
        f.history("own", Q2[0], Q1[1])
        + " SELECT customer_id, article_id, n, CAST(rank AS INTEGER) AS rank FROM own"
    ),
)
def history_items(spark, sf_dir):
    return history.history_items(retail(spark, sf_dir).tx, Q2[0], Q1[1])


STATS_SQL = f"""
counts AS (SELECT article_id, count(*) AS article_count, min(price) AS article_min_price
           FROM tx WHERE {f.window(Q4[0], Q1[1])} GROUP BY 1),
{f.best_other("best", "counts", "prod_name").strip()}"""


@query(
    "alternate_most_popular",
    retail_sql(
        STATS_SQL
        + """ SELECT article_id, other_id AS next_best_article, article_count, other_count AS next_best_count
        FROM best WHERE other_count > 2 * article_count"""
    ),
)
def alternate_most_popular(spark, sf_dir):
    shop = retail(spark, sf_dir)
    return related.alternates(windows.date_window(shop.tx, Q4[0], Q1[1]), shop.articles)


@query(
    "alternate_most_popular_price",
    retail_sql(
        STATS_SQL
        + """ SELECT article_id, other_id AS next_best_article, article_count, other_count AS next_best_count
        FROM best WHERE other_count > 2 * article_count AND article_min_price >= other_min_price"""
    ),
)
def alternate_most_popular_price(spark, sf_dir):
    shop = retail(spark, sf_dir)
    return related.alternates(
        windows.date_window(shop.tx, Q4[0], Q1[1]), shop.articles, price_rule=True
    )


@query(
    "alternate_single_sibling",
    retail_sql(
        STATS_SQL
        + """ SELECT b.article_id, other_id AS next_best_article, article_count, other_count AS next_best_count
        FROM best b JOIN articles a ON a.article_id = b.article_id
        JOIN (SELECT prod_name FROM articles GROUP BY 1 HAVING count(*) = 2) s ON s.prod_name = a.prod_name
        WHERE other_count > 1 * article_count"""
    ),
)
def alternate_single_sibling(spark, sf_dir):
    shop = retail(spark, sf_dir)
    return related.alternates(
        windows.date_window(shop.tx, Q4[0], Q1[1]),
        shop.articles,
        factor=1,
        single_sibling_only=True,
    )


def pairs_sql(last, days) -> str:
    return f"""
baskets AS (SELECT DISTINCT customer_id, {f.bucket(last, days)} AS week_end, article_id FROM tx),
common AS (SELECT article_id, count(*) AS baskets FROM baskets GROUP BY 1),
counted AS (
  SELECT a.article_id, b.article_id AS article_id2, count(*) AS n
  FROM baskets a JOIN baskets b
    ON b.customer_id = a.customer_id AND b.week_end = a.week_end AND b.article_id <> a.article_id
  GROUP BY 1, 2),
pairs AS (
  SELECT c.article_id, c.article_id2, c.n FROM counted c JOIN common o ON o.article_id = c.article_id2
  QUALIFY row_number() OVER (PARTITION BY c.article_id ORDER BY c.n DESC, o.baskets DESC, c.article_id2) = 1)"""


@query(
    "copurchase_pairs",
    retail_sql(pairs_sql(RETAIL_LAST, RETAIL_DAYS) + " SELECT article_id, article_id2, n FROM pairs"),
)
def copurchase_pairs(spark, sf_dir):
    return related.copurchase_pairs(retail(spark, sf_dir).tx, RETAIL_LAST, RETAIL_DAYS)


def _last_purchase_sql(where: str, days: int) -> str:
    return f"""
past AS (SELECT * FROM tx WHERE {where}),
latest AS (SELECT customer_id, article_id, max(t_dat) AS last_dat FROM (
             SELECT *, max(t_dat) OVER (PARTITION BY customer_id) AS l_dat FROM past)
           WHERE l_dat - t_dat < {days} GROUP BY 1, 2),
bought AS (SELECT customer_id, article_id, last_dat,
                  row_number() OVER (PARTITION BY customer_id ORDER BY last_dat DESC, article_id) AS rank
           FROM latest)"""


@query(
    "last_purchase_items",
    clicks_sql(
        _last_purchase_sql("TRUE", 14)
        + " SELECT customer_id, article_id, last_dat, rank FROM bought"
    ),
)
def last_purchase_items(spark, sf_dir):
    return history.last_purchase_items(clicks(spark, sf_dir).tx, 14)


# The blend looks from the last training day; its day counts are 13 times those
# of a shop with weekly windows.
BLEND_LAST = RETAIL_REF - dt.timedelta(days=1)
PURCHASE_DAYS = 14 * RETAIL_STRETCH
VARIANT_DAYS = 7 * RETAIL_STRETCH - 1
SEGMENT_DAYS = 5 * RETAIL_STRETCH - 1
SOLD_DAYS = 12 * RETAIL_STRETCH - 1

BOUGHT_SQL = _last_purchase_sql(f"t_dat <= DATE '{BLEND_LAST}'", PURCHASE_DAYS)

VARIANT_SQL = f"""
variant_counts AS (
  SELECT article_id, count(*) AS article_count, NULL::DOUBLE AS article_min_price FROM past
  WHERE t_dat BETWEEN DATE '{BLEND_LAST}' - {VARIANT_DAYS} AND DATE '{BLEND_LAST}' GROUP BY 1),
{f.best_other("variant", "variant_counts", "product_code").strip()},
variants AS (
  SELECT b.customer_id, v.other_id AS article_id,
         row_number() OVER (PARTITION BY b.customer_id ORDER BY b.rank) AS rank
  FROM bought b JOIN variant v ON v.article_id = b.article_id)"""


@query(
    "variant_items",
    retail_sql(BOUGHT_SQL + "," + VARIANT_SQL + " SELECT customer_id, article_id, rank FROM variants"),
)
def variant_items(spark, sf_dir):
    shop = retail(spark, sf_dir)
    past = shop.tx.where(F.col("t_dat") <= F.lit(BLEND_LAST))
    bought = history.last_purchase_items(past, PURCHASE_DAYS)
    return related.variant_items(bought, past, shop.articles, BLEND_LAST, VARIANT_DAYS)


def _segment_sql(name: str, groups: str) -> str:
    return f"""
{name} AS (
  SELECT segment, article_id, n, row_number() OVER (PARTITION BY segment ORDER BY n DESC, article_id) AS rank
  FROM (SELECT g.segment, t.article_id, count(*) AS n
        FROM tx t JOIN {groups} g ON g.customer_id = t.customer_id
        WHERE t.t_dat BETWEEN DATE '{BLEND_LAST}' - {SEGMENT_DAYS} AND DATE '{BLEND_LAST}'
        GROUP BY 1, 2)
  QUALIFY rank <= 12)"""


AGE_SQL = f"""
age_groups AS (SELECT customer_id, CAST({AGE_BIN_SQL} AS INTEGER) AS segment FROM customers),
{_segment_sql("age_items", "age_groups").strip()}"""
CHANNEL_SQL = CHANNEL_GROUP_SQL + "," + _segment_sql("channel_items", "groups")


@query(
    "segment_popular_channel",
    retail_sql(
        CHANNEL_SQL
        + """ SELECT g.customer_id, i.article_id, CAST(i.rank AS BIGINT) AS rank
        FROM groups g JOIN channel_items i ON i.segment = g.segment"""
    ),
)
def segment_popular_channel(spark, sf_dir):
    shop = retail(spark, sf_dir)
    groups = popularity.population_channel_group(shop.population, shop.tx)
    best = popularity.segment_popular(shop.tx, groups, BLEND_LAST, SEGMENT_DAYS)
    return combine.segment_items(groups, best)


@query(
    "segment_popular_age",
    retail_sql(
        AGE_SQL
        + """ SELECT g.customer_id, i.article_id, CAST(i.rank AS BIGINT) AS rank
        FROM age_groups g JOIN age_items i ON i.segment = g.segment"""
    ),
)
def segment_popular_age(spark, sf_dir):
    shop = retail(spark, sf_dir)
    groups = popularity.age_group(shop.customers)
    best = popularity.segment_popular(shop.tx, groups, BLEND_LAST, SEGMENT_DAYS)
    return combine.segment_items(groups, best, max_segments=len(popularity.AGE_EDGES))


# --- recommenders -----------------------------------------------------------------


@query("reco_top12", retail_sql(BUYERS_SQL + "," + f.cut([f.fill("pop")]) + f.PREDICTIONS))
def reco_top12(spark, sf_dir):
    shop = retail(spark, sf_dir)
    return combine.to_predictions(recommend.top12(shop.tx, shop.population))


@query(
    "reco_history_fill",
    retail_sql(
        ",".join(
            [
                f.history("own", Q2[0], Q1[1]),
                f.popular("pop", Q2[0], Q1[1]),
                f.cut([f.own("own"), f.fill("pop")]),
            ]
        )
        + f.PREDICTIONS
    ),
)
def reco_history_fill(spark, sf_dir):
    shop = retail(spark, sf_dir)
    return combine.to_predictions(
        recommend.history_fill(shop.tx, shop.population, Q2[0], Q1[1])
    )


@query(
    "reco_history_fill_dedup",
    retail_sql(
        ",".join(
            [
                f.history("own", Q2[0], Q1[1]),
                f.popular("pop", Q2[0], Q1[1], k=24),
                """
new_pop AS (SELECT p.customer_id, f.article_id, f.rank FROM population p CROSS JOIN pop f
            WHERE NOT EXISTS (SELECT 1 FROM own o WHERE o.customer_id = p.customer_id
                              AND o.article_id = f.article_id))""",
                f.cut([f.own("own"), f.own("new_pop", 99)]),
            ]
        )
        + f.PREDICTIONS
    ),
)
def reco_history_fill_dedup(spark, sf_dir):
    shop = retail(spark, sf_dir)
    return combine.to_predictions(
        recommend.history_fill(shop.tx, shop.population, Q2[0], Q1[1], dedup=True)
    )


@query(
    "reco_two_tier",
    retail_sql(
        ",".join(
            [
                f.history("recent", *Q1),
                f.history("older", Q3[0], Q2[1]),
                f.popular("pop", *Q1),
                """
older_only AS (SELECT * FROM older WHERE rank <= 4
               AND customer_id NOT IN (SELECT customer_id FROM recent))""",
                f.cut([f.own("recent"), f.own("older_only", 1), f.fill("pop")]),
            ]
        )
        + f.PREDICTIONS
    ),
)
def reco_two_tier(spark, sf_dir):
    shop = retail(spark, sf_dir)
    return combine.to_predictions(
        recommend.two_tier(shop.tx, shop.population, Q1, (Q3[0], Q2[1]))
    )


def _best_sellers(name, start, end):
    return f"""
{name} AS (SELECT article_id, row_number() OVER (ORDER BY n DESC, article_id) AS rank
           FROM (SELECT article_id, count(*) AS n FROM tx WHERE {f.window(start, end)} GROUP BY 1)
           QUALIFY rank <= 12)"""


@query(
    "reco_three_tier",
    retail_sql(
        ",".join(
            [
                *[f.history(f"h{i}", q[0], Q1[1]) for i, q in enumerate((Q1, Q2, Q3), start=1)],
                *[_best_sellers(f"b{i}", q[0], Q1[1]) for i, q in enumerate((Q1, Q2, Q3), start=1)],
                """
tiers AS (SELECT p.customer_id,
                 CASE WHEN p.customer_id IN (SELECT customer_id FROM h1) THEN 1
                      WHEN p.customer_id IN (SELECT customer_id FROM h2) THEN 2
                      WHEN p.customer_id IN (SELECT customer_id FROM h3) THEN 3 END AS tier
          FROM population p)""",
                f.cut(
                    [
                        part
                        for i in (1, 2, 3)
                        for part in (
                            f"SELECT h.customer_id, h.article_id, 0 AS s1, 0 AS s2, h.rank AS s3 "
                            f"FROM h{i} h JOIN tiers t ON t.customer_id = h.customer_id AND t.tier = {i}",
                            f"SELECT t.customer_id, b.article_id, 9 AS s1, 0 AS s2, b.rank AS s3 "
                            f"FROM tiers t CROSS JOIN b{i} b WHERE coalesce(t.tier, 2) = {i}",
                        )
                    ]
                ),
            ]
        )
        + f.PREDICTIONS
    ),
)
def reco_three_tier(spark, sf_dir):
    shop = retail(spark, sf_dir)
    return combine.to_predictions(
        recommend.three_tier(shop.tx, shop.population, [Q1, Q2, Q3])
    )


@query(
    "reco_stacked",
    clicks_sql(
        ",".join(
            [
                STACK_SQL,
                f.popular("pop", W2[0], W1[1]),
                f.cut([*[f.own(f"h{i}", i) for i in (1, 2, 3, 4)], f.fill("pop")]),
            ]
        )
        + f.PREDICTIONS
    ),
)
def reco_stacked(spark, sf_dir):
    shop = clicks(spark, sf_dir)
    return combine.to_predictions(
        recommend.stacked(shop.tx, shop.population, CLICKS_WINDOWS[:4])
    )


def _alternates_ctes(price_rule: bool) -> list[str]:
    rule = "other_count > 2 * article_count"
    if price_rule:
        rule += " AND article_min_price >= other_min_price"
    return [
        f.numbered("w", RETAIL_WINDOWS),
        """
window_counts AS (SELECT window_no, article_id, count(*) AS article_count,
                         min(price) AS article_min_price FROM w GROUP BY 1, 2)""",
        f.best_other("best", "window_counts", "prod_name", by="window_no"),
        f"""
better AS (SELECT window_no - 1 AS window_no, article_id, other_id FROM best WHERE {rule})""",
        *[f.history(f"h{i}", *q) for i, q in enumerate(RETAIL_WINDOWS[:4], start=1)],
        """
own AS ("""
        + " UNION ALL ".join(
            f"SELECT customer_id, {i} AS window_no, 0 AS part, article_id, rank FROM h{i}"
            for i in (1, 2, 3, 4)
        )
        + """),
extra AS (SELECT o.customer_id, o.window_no, 1 AS part, b.other_id AS article_id, o.rank
          FROM own o JOIN better b ON b.window_no = o.window_no AND b.article_id = o.article_id)""",
    ]


STACKED_PARTS = [
    "SELECT customer_id, article_id, window_no AS s1, part AS s2, rank AS s3 FROM own",
    "SELECT customer_id, article_id, window_no AS s1, part AS s2, rank AS s3 FROM extra",
]


@query(
    "reco_stacked_alternates",
    retail_sql(
        ",".join(
            [
                *_alternates_ctes(price_rule=True),
                f.popular("pop", Q2[0], Q1[1]),
                f.cut([*STACKED_PARTS, f.fill("pop")]),
            ]
        )
        + f.PREDICTIONS
    ),
)
def reco_stacked_alternates(spark, sf_dir):
    shop = retail(spark, sf_dir)
    return combine.to_predictions(
        recommend.stacked_alternates(
            shop.tx, shop.articles, shop.population, RETAIL_WINDOWS, price_rule=True
        )
    )


@query(
    "reco_channel_fill",
    retail_sql(
        ",".join(
            [
                *_alternates_ctes(price_rule=False),
                f.popular("pop", Q2[0], Q1[1]),
                f.popular("pop1", Q2[0], Q1[1], where="sales_channel_id = 1"),
                f.popular("pop2", Q2[0], Q1[1], where="sales_channel_id = 2"),
                f"""
channels AS (SELECT p.customer_id, min(t.sales_channel_id) AS channel FROM population p
             LEFT JOIN tx t ON t.customer_id = p.customer_id AND {f.window(Q2[0], Q1[1])} GROUP BY 1)""",
                f.cut(
                    [
                        *STACKED_PARTS,
                        f.fill("pop", who="(SELECT customer_id FROM channels WHERE channel IS NULL)"),
                        f.fill("pop1", who="(SELECT customer_id FROM channels WHERE channel = 1)"),
                        f.fill("pop2", who="(SELECT customer_id FROM channels WHERE channel = 2)"),
                    ]
                ),
            ]
        )
        + f.PREDICTIONS
    ),
)
def reco_channel_fill(spark, sf_dir):
    shop = retail(spark, sf_dir)
    return combine.to_predictions(
        recommend.channel_fill(shop.tx, shop.articles, shop.population, RETAIL_WINDOWS)
    )


@query(
    "reco_trend",
    clicks_sql(
        ",".join(
            [
                TREND_SQL,
                """
general AS (SELECT article_id, row_number() OVER (ORDER BY score DESC, article_id) AS rank
            FROM article_trend QUALIFY rank <= 12),
own AS (SELECT customer_id, article_id, row_number() OVER (PARTITION BY customer_id
               ORDER BY score DESC, first_dat, article_id) AS rank
        FROM customer_trend QUALIFY rank <= 12)""",
                f.cut([f.own("own"), f.fill("general")]),
            ]
        )
        + f.PREDICTIONS
    ),
)
def reco_trend(spark, sf_dir):
    shop = clicks(spark, sf_dir)
    return combine.to_predictions(recommend.trend(shop.tx, shop.population, CLICKS_LAST))


@query(
    "reco_last_week_pairs",
    clicks_sql(
        ",".join(
            [
                pairs_sql(CLICKS_LAST, 7),
                LAST_WEEK_SQL,
                f"""
best AS (SELECT article_id, row_number() OVER (ORDER BY n DESC, article_id) AS rank
         FROM (SELECT article_id, count(*) AS n FROM tx
               WHERE t_dat BETWEEN DATE '{CLICKS_LAST}' - 6 AND DATE '{CLICKS_LAST}' GROUP BY 1)
         QUALIFY rank <= 12),
both_parts AS (
  SELECT customer_id, article_id, 0 AS part, rank FROM last_week
  UNION ALL
  SELECT l.customer_id, p.article_id2 AS article_id, 1 AS part, l.rank
  FROM last_week l JOIN pairs p ON p.article_id = l.article_id),
once AS (SELECT customer_id, article_id, min(part * 100 + rank) AS rank FROM both_parts GROUP BY 1, 2)""",
                f.cut([f.own("once"), f.fill("best")]),
            ]
        )
        + f.PREDICTIONS
    ),
)
def reco_last_week_pairs(spark, sf_dir):
    shop = clicks(spark, sf_dir)
    pairs = related.copurchase_pairs(shop.tx, CLICKS_LAST)
    return combine.to_predictions(
        recommend.last_week_pairs(shop.tx, shop.population, pairs, CLICKS_LAST)
    )


@query("reco_als")
def reco_als(spark, sf_dir):
    shop = clicks(spark, sf_dir)
    train = windows.date_window(shop.tx, W4[0], W1[1])
    return combine.to_predictions(recommend.als(train, shop.population, SMALL_FACTORS))


@query("reco_mf_rerank")
def reco_mf_rerank(spark, sf_dir):
    shop = clicks(spark, sf_dir)
    return combine.to_predictions(
        recommend.mf_rerank(
            shop.tx, shop.population, W2[0], W1[1], settings=SMALL_RERANK
        )
    )


@query("lowest_prediction_first")
def lowest_prediction_first(spark, sf_dir):
    tx = clicks(spark, sf_dir).tx
    return factor.mf_reranked_items(tx, W2[0], W1[1], settings=SMALL_RERANK).withColumn(
        "predicted", F.round("predicted", 6)
    )


# What SQL can say of the factor models: their exact parts, and what must hold of each list.

TRAIN_SQL = f"train AS (SELECT customer_id, article_id, count(*) AS n FROM tx WHERE {f.window(W2[0], W1[1])} GROUP BY 1, 2)"


@query(
    "mf_bias_terms",
    clicks_sql(
        TRAIN_SQL
        + """, fed AS (
  SELECT customer_id, article_id, n / (sum(n) OVER (PARTITION BY article_id) * sum(n) OVER (PARTITION BY customer_id))::DOUBLE AS x FROM train),
centred AS (SELECT *, x - (SELECT avg(x) FROM fed) AS c FROM fed),
items AS (SELECT *, avg(c) OVER (PARTITION BY article_id) AS item_bias FROM centred),
users AS (SELECT *, avg(c - item_bias) OVER (PARTITION BY customer_id) AS user_bias FROM items)
SELECT customer_id, article_id, round(x, 9) AS feedback, round(item_bias, 9) AS item_bias,
       round(user_bias, 9) AS user_bias, round(c - item_bias - user_bias, 9) AS residual FROM users"""
    ),
)
def mf_bias_terms(spark, sf_dir):
    terms = factor.bias_terms(windows.date_window(clicks(spark, sf_dir).tx, W2[0], W1[1]))
    numbers = ["feedback", "item_bias", "user_bias", "residual"]
    return terms.select("customer_id", "article_id", *[F.round(c, 9).alias(c) for c in numbers])


@query(
    "mf_rerank_sets",
    clicks_sql(
        TRAIN_SQL
        + """ SELECT customer_id, string_agg(article_id, ' ' ORDER BY article_id) AS articles
        FROM train GROUP BY 1 HAVING count(*) <= 12"""
    ),
)
def mf_rerank_sets(spark, sf_dir):
    """Customers of at most 12 articles get all of them, in whatever order."""
    tx = clicks(spark, sf_dir).tx
    ranked = factor.mf_reranked_items(tx, W2[0], W1[1], settings=SMALL_RERANK)
    few = windows.date_window(tx, W2[0], W1[1]).groupBy("customer_id").agg(F.count_distinct("article_id").alias("n"))
    sets = ranked.groupBy("customer_id").agg(F.array_join(F.sort_array(F.collect_list("article_id")), " ").alias("articles"))
    return sets.join(few.where("n <= 12"), "customer_id").select("customer_id", "articles")


@query(
    "lowest_prediction_order",
    clicks_sql(
        TRAIN_SQL + " SELECT customer_id, least(count(*), 12) AS n, TRUE AS rising FROM train GROUP BY 1"
    ),
)
def lowest_prediction_order(spark, sf_dir):
    """Predictions rise with the rank, also if the model is of an earlier window."""
    tx = clicks(spark, sf_dir).tx
    ranked = factor.mf_reranked_items(tx, W2[0], W1[1], settings=SMALL_RERANK, model_as_of=(W4[0], W2[0]))
    by_rank = F.transform(F.array_sort(F.collect_list(F.struct("rank", "predicted"))), lambda p: p["predicted"])
    return ranked.groupBy("customer_id").agg(
        F.count("*").alias("n"), (by_rank == F.array_sort(F.collect_list("predicted"))).alias("rising")
    )


@query(
    "als_list_properties",
    clicks_sql(
        f"""catalogue AS (SELECT DISTINCT article_id FROM tx WHERE {f.window(W4[0], W1[1])})
        SELECT customer_id, least(12, (SELECT count(*) FROM catalogue)) AS n,
               least(12, (SELECT count(*) FROM catalogue)) AS different,
               least(12, (SELECT count(*) FROM catalogue)) AS known FROM population"""
    ),
)
def als_list_properties(spark, sf_dir):
    """Everyone gets twelve different articles that were sold in the training window."""
    shop = clicks(spark, sf_dir)
    train = windows.date_window(shop.tx, W4[0], W1[1])
    lists = recommend.als(train, shop.population, SMALL_FACTORS)
    items = lists.select("customer_id", F.explode("items").alias("article_id"))
    sold = train.select("article_id", F.lit(1).alias("sold")).distinct()
    return items.join(sold, "article_id", "left").groupBy("customer_id").agg(
        F.count("*").alias("n"), F.count_distinct("article_id").alias("different"), F.count("sold").alias("known")
    )


def _blend_sql(segments: list[tuple[str, str, str]]) -> str:
    """Blend of purchases, variants and the (CTEs, groups, items) of each segment list."""
    parts = [
        "SELECT customer_id, article_id, 0 AS list_no, rank, 100.0::DOUBLE / rank AS part FROM bought",
        "SELECT customer_id, article_id, 1 AS list_no, rank, 10.0::DOUBLE / rank AS part FROM variants",
    ]
    ctes = [BOUGHT_SQL, VARIANT_SQL]
    for i, (cte, groups, items) in enumerate(segments, start=2):
        ctes.append(cte)
        parts.append(
            f"SELECT g.customer_id, i.article_id, {i} AS list_no, i.rank, 1.0::DOUBLE / i.rank AS part "
            f"FROM {groups} g JOIN {items} i ON i.segment = g.segment"
        )
    ctes.append(
        "\nparts AS ("
        + "\nUNION ALL\n".join(parts)
        + f"""),
scores AS (SELECT customer_id, article_id, round(sum(part), 9) AS score,
                  min(list_no * 1000000 + rank) AS first_place FROM parts GROUP BY 1, 2),
mixed AS (SELECT customer_id, article_id, row_number() OVER (PARTITION BY customer_id
                 ORDER BY score DESC, first_place) AS place FROM scores QUALIFY place <= 32),
kept AS (SELECT * FROM mixed WHERE article_id IN (
           SELECT article_id FROM tx
           WHERE t_dat BETWEEN DATE '{BLEND_LAST}' - {SOLD_DAYS} AND DATE '{BLEND_LAST}')),
lists AS (SELECT customer_id, article_id, row_number() OVER (PARTITION BY customer_id ORDER BY place) AS rank
          FROM kept QUALIFY rank <= 12)"""
    )
    return retail_sql(",".join(ctes) + f.ALL_PREDICTIONS)


def _blend(by_channel: bool, by_age: bool):
    def run(spark, sf_dir):
        shop = retail(spark, sf_dir)
        return combine.to_predictions(
            recommend.blended(
                shop.tx,
                shop.articles,
                shop.customers,
                shop.population,
                BLEND_LAST,
                by_channel=by_channel,
                by_age=by_age,
                purchase_days=PURCHASE_DAYS,
                variant_days=VARIANT_DAYS,
                segment_days=SEGMENT_DAYS,
                sold_days=SOLD_DAYS,
            )
        )

    return run


CHANNEL_PART = (CHANNEL_SQL, "groups", "channel_items")
AGE_PART = (AGE_SQL, "age_groups", "age_items")
query("reco_blend", _blend_sql([CHANNEL_PART, AGE_PART]))(_blend(True, True))
query("reco_blend_channel", _blend_sql([CHANNEL_PART]))(_blend(True, False))
query("reco_blend_age", _blend_sql([AGE_PART]))(_blend(False, True))
