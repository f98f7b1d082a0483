"""Matrix factorisation on purchase counts, with Spark ML's ALS."""

from __future__ import annotations

import itertools
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.dates import DateLike
from basketry.functions.keys import LIST_LENGTH
from basketry.operators.combine import list_literal, population_lists, to_lists
from basketry.operators.evaluate import map_at_k
from basketry.operators.history import history_items
from basketry.operators.inner import best_items
from basketry.operators.popularity import article_counts, top_k_global
from basketry.operators.skew import join_totals, positions, top_per_group
from basketry.operators.windows import date_window, temporal_split
from basketry.sources.lineage import cut_lineage, ensure_checkpoint_dir

ID_BUCKETS = 4096


@dataclass(frozen=True)
class FactorSettings:
    """ALS settings; the defaults are the smallest set of the grid.

    ``blocks`` is the number of user and item blocks; by default as many as the
    session has shuffle partitions, so that a block fits into a task.
    """

    rank: int = 40
    iterations: int = 3
    regularization: float = 0.01
    alpha: float = 1.0
    seed: int = 42
    blocks: int | None = None


# Fixed values of the grid search.
GRID_RANKS = (40, 50, 60, 100, 200, 500, 1000)
GRID_ITERATIONS = (3, 12, 14, 15, 20)
GRID_REGULARIZATION = (0.01,)


def full_grid() -> list[FactorSettings]:
    return [
        FactorSettings(rank, iterations, regularization)
        for rank, iterations, regularization in itertools.product(
            GRID_RANKS, GRID_ITERATIONS, GRID_REGULARIZATION
        )
    ]


def _als(rows: DataFrame, settings: FactorSettings, **options) -> ALS:
    """ALS on the columns ``user``, ``item`` and ``rating``."""
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    blocks = settings.blocks or max(10, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return ALS(
        rank=settings.rank,
        maxIter=settings.iterations,
        regParam=settings.regularization,
        alpha=settings.alpha,
        seed=settings.seed,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        userCol="user",
        itemCol="item",
        ratingCol="rating",
        **options,
    )


def dense_ids(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Distinct keys numbered 0 .. n-1: ``key, name``.

    Keys are numbered within hash buckets, and only the bucket sizes meet in one
    place, so neither the driver nor a task ever holds all keys.
    """
    keys = rows.select(key).distinct().withColumn("_all", F.lit(1))
    numbered = positions(
        keys,
        ["_all"],
        {"_bucket": F.pmod(F.xxhash64(key), F.lit(ID_BUCKETS)).cast("int")},
        [F.asc(key)],
        name=name,
    )
    return numbered.select(key, (F.col(name) - 1).cast("int").alias(name))


@dataclass(frozen=True)
class Ratings:
    """``user, item, rating`` and the tables from ids to numbers, all written once."""

    ratings: DataFrame
    users: DataFrame
    items: DataFrame


def numbered_ratings(pairs: DataFrame) -> Ratings:
    """Dense integer ids for ``customer_id, article_id, rating``."""
    pairs = cut_lineage(pairs)
    users = cut_lineage(dense_ids(pairs, "customer_id", "user"))
    items = cut_lineage(dense_ids(pairs, "article_id", "item"))
    joined = join_totals(join_totals(pairs, users, ["customer_id"]), items, ["article_id"])
    return Ratings(cut_lineage(joined.select("user", "item", "rating")), users, items)


def purchase_ratings(tx: DataFrame) -> Ratings:
    """Number of purchases per (customer, article)."""
    return numbered_ratings(
        tx.groupBy("customer_id", "article_id").agg(
            F.count(F.lit(1)).cast("float").alias("rating")
        )
    )


def normalised_feedback(tx: DataFrame) -> DataFrame:
    """``n(u, i) / (n(i) * n(u))`` per (customer, article), as ``feedback``."""
    pair = tx.groupBy("customer_id", "article_id").agg(F.count(F.lit(1)).alias("n"))
    per_item = pair.groupBy("article_id").agg(F.sum("n").alias("n_item"))
    per_user = pair.groupBy("customer_id").agg(F.sum("n").alias("n_user"))
    joined = join_totals(join_totals(pair, per_item, ["article_id"]), per_user, ["customer_id"])
    return joined.select(
        "customer_id",
        "article_id",
        "n",
        (F.col("n") / (F.col("n_item") * F.col("n_user"))).alias("feedback"),
    )


def als_items(
    data: Ratings,
    population: DataFrame,
    settings: FactorSettings = FactorSettings(),
    k: int = LIST_LENGTH,
) -> DataFrame:
    """Top ``k`` articles by implicit-feedback ALS: ``customer_id, rank, article_id``.

    Bought articles may come back. Only customers with factors get rows. Articles
    that cannot be among a customer's best by their norm are not scored.
    """
    model = _als(data.ratings, settings, implicitPrefs=True, coldStartStrategy="drop").fit(
        data.ratings
    )
    wanted = data.users.join(population.select("customer_id"), "customer_id", "left_semi")
    users = model.userFactors.join(wanted, F.col("id") == F.col("user")).select("id", "features")
    best = best_items(users, model.itemFactors, k)
    return (
        best.select(F.col("id").alias("user"), "rank", "item")
        .join(data.items, "item")
        .join(data.users, "user")
        .select("customer_id", "rank", "article_id")
    )


def als_lists(
    tx: DataFrame,
    population: DataFrame,
    settings: FactorSettings = FactorSettings(),
    k: int = LIST_LENGTH,
    data: Ratings | None = None,
) -> DataFrame:
    """ALS lists for the population; customers without factors get the most bought articles.

    ``data`` is ``purchase_ratings(tx)``, if several fits share it.
    """
    data = purchase_ratings(tx) if data is None else data
    popular = list_literal(top_k_global(article_counts(tx), k), k)
    return population_lists(
        population, to_lists(als_items(data, population, settings, k), k=k), popular, k
    )


def als_validation(
    tx: DataFrame,
    cut: DateLike,
    settings: FactorSettings = FactorSettings(),
    k: int = LIST_LENGTH,
) -> DataFrame:
    """Fit before the cut date, score the customers who buy on or after it."""
    train, valid = temporal_split(tx, cut)
    buyers = valid.select("customer_id").distinct()
    return map_at_k(valid, als_lists(train, buyers, settings, k), k)


def grid_search(
    tx: DataFrame,
    cut: DateLike,
    grid: list[FactorSettings] | None = None,
    k: int = LIST_LENGTH,
    parallel: int = 4,
) -> DataFrame:
    """Score of every setting of the grid, with the first best one marked.

    The hold-out is split by time, so each setting is one fit on the same
    training rows, which are numbered and written once; only one number per
    setting comes to the driver. ``parallel`` fits run at the same time, each in a
    scheduler pool of its own, so that one fills the cores that another's last
    tasks leave; sessions with ``spark.scheduler.mode=FAIR`` share evenly.
    """
    grid = full_grid() if grid is None else grid
    train, valid = temporal_split(tx.select("t_dat", "customer_id", "article_id"), cut)
    train, valid = cut_lineage(train), cut_lineage(valid)
    buyers = valid.select("customer_id").distinct()
    data = purchase_ratings(train)
    spark = tx.sparkSession

    def score(number: int) -> float:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{number}")
        return map_at_k(valid, als_lists(train, buyers, grid[number], k, data), k).first()["map"]

    with ThreadPoolExecutor(parallel) as threads:
        scores = list(threads.map(inheritable_thread_target(spark)(score), range(len(grid))))
    best = max(range(len(grid)), key=lambda i: scores[i])
    rows = [
        (s.rank, s.iterations, s.regularization, score, i == best)
        for i, (s, score) in enumerate(zip(grid, scores))
    ]
    return tx.sparkSession.createDataFrame(
        rows, "factors int, iterations int, regularization double, map double, best boolean"
    )


def mf_reranked_items(
    tx: DataFrame,
    start: DateLike,
    end: DateLike,
    candidates: int = 20,
    k: int = LIST_LENGTH,
    settings: FactorSettings = FactorSettings(rank=64, iterations=10, regularization=0.2),
    ascending: bool = True,
    model_as_of: tuple[DateLike, DateLike] | None = None,
) -> DataFrame:
    """Each customer's frequent articles of ``[start, end)`` re-ranked by predicted feedback.

    Biased matrix factorisation: the global mean and the item and customer biases
    are averages, ALS is fitted to what they leave over, and only the candidate
    rows are scored. ``ascending`` puts the lowest prediction first. The model is
    fitted on the window ``model_as_of`` (default: the candidates' own); customers
    and articles it does not know have no bias and no factors. The biases are
    written to the checkpoint folder while the plan is made.
    """
    biased = bias_terms(date_window(tx, *(model_as_of or (start, end))))
    item_bias = biased.select("article_id", "item_bias").distinct()
    user_bias = biased.select("customer_id", "user_bias").distinct()
    mean = biased.agg(F.avg("feedback")).scalar()
    residual = biased.select("customer_id", "article_id", F.col("residual").cast("float").alias("rating"))
    data = numbered_ratings(residual)
    model = _als(data.ratings, settings, coldStartStrategy="nan").fit(data.ratings)

    rows = history_items(tx, start, end, candidates)
    rows = join_totals(rows, data.users.join(user_bias, "customer_id"), ["customer_id"], "left")
    rows = join_totals(rows, data.items.join(item_bias, "article_id"), ["article_id"], "left")
    unknown = {"user": F.coalesce("user", F.lit(-1)), "item": F.coalesce("item", F.lit(-1))}
    scored = model.transform(rows.withColumns(unknown)).withColumn(
        "predicted",
        mean
        + F.coalesce("item_bias", F.lit(0.0))
        + F.coalesce("user_bias", F.lit(0.0))
        + F.nanvl("prediction", F.lit(0.0)),
    )
    by_score = F.asc("predicted") if ascending else F.desc("predicted")
    ranked = scored.select("customer_id", "article_id", "predicted", F.col("rank").alias("_old"))
    return top_per_group(ranked, ["customer_id"], [by_score, F.asc("_old")], k).select(
        "customer_id", "rank", "article_id", "predicted"
    )


def bias_terms(window: DataFrame) -> DataFrame:
    """Feedback per (customer, article) with ``item_bias``, ``user_bias`` and the ``residual``, computed once.

    The item bias is the mean of what is over the global mean, the user bias the
    mean of what is over that and the item bias.
    """
    feedback = cut_lineage(normalised_feedback(window))
    mean = feedback.agg(F.avg("feedback")).scalar()
    centred = feedback.withColumn("_c", F.col("feedback") - mean)
    item_bias = centred.groupBy("article_id").agg(F.avg("_c").alias("item_bias"))
    centred = join_totals(centred, item_bias, ["article_id"])
    user_bias = centred.groupBy("customer_id").agg(
        F.avg(F.col("_c") - F.col("item_bias")).alias("user_bias")
    )
    residual = F.col("_c") - F.col("item_bias") - F.col("user_bias")
    return cut_lineage(
        join_totals(centred, user_bias, ["customer_id"]).select(
            "customer_id", "article_id", "feedback", "item_bias", "user_bias", residual.alias("residual")
        )
    )
