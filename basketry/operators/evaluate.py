"""Mean average precision and other checks of predicted lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.dates import DateLike, as_date, day_diff, inverse_days
from basketry.functions.keys import LIST_LENGTH
from basketry.functions.lists import list_fill
from basketry.operators.combine import to_lists
from basketry.operators.history import frequent_first
from basketry.operators.popularity import SCORE_DIGITS, popular_order
from basketry.operators.skew import attach_segment_list, top_per_group
from basketry.operators.windows import WindowList

METRIC_DIGITS = 6


def ap_at_k(
    actual: DataFrame,
    predicted: DataFrame,
    k: int = LIST_LENGTH,
    by: list[str] | None = None,
) -> DataFrame:
    """Average precision at ``k`` for everyone with purchases: ``[by,] customer_id, ap``.

    ``actual`` holds purchase rows, ``predicted`` an array ``items`` per
    customer. A repeated prediction counts once, at its first place; a repeated
    purchase counts in the number of purchases that divides the score.
    """
    keys = [*(by or []), "customer_id"]
    bought = actual.groupBy(*keys, "article_id").agg(F.count(F.lit(1)).alias("n"))
    totals = bought.groupBy(*keys).agg(F.sum("n").alias("n_actual"))
    places = (
        predicted.select(
            *keys, F.posexplode(F.slice("items", 1, k)).alias("_pos", "article_id")
        )
        .groupBy(*keys, "article_id")
        .agg((F.min("_pos") + 1).alias("_place"))
    )
    hits = places.join(bought.select(*keys, "article_id"), [*keys, "article_id"])
    so_far = F.row_number().over(Window.partitionBy(*keys).orderBy("_place"))
    gain = (
        hits.withColumn("_precision", so_far / F.col("_place"))
        .groupBy(*keys)
        .agg(F.sum("_precision").alias("_gain"))
    )
    score = F.coalesce("_gain", F.lit(0.0)) / F.least("n_actual", F.lit(k))
    return totals.join(gain, keys, "left").select(
        *keys, F.round(score, SCORE_DIGITS).alias("ap")
    )


def map_at_k(
    actual: DataFrame,
    predicted: DataFrame,
    k: int = LIST_LENGTH,
    by: list[str] | None = None,
) -> DataFrame:
    """Mean of the average precisions over everyone with purchases."""
    scores = ap_at_k(actual, predicted, k, by)
    return scores.groupBy(*(by or [])).agg(
        F.round(F.avg("ap"), METRIC_DIGITS).alias("map"),
        F.count(F.lit(1)).alias("customers"),
    )


def map_by_group(
    actual: DataFrame, predicted: DataFrame, groups: DataFrame, k: int = LIST_LENGTH
) -> DataFrame:
    """Mean average precision overall and per segment: ``segment, map, customers``.

    ``groups`` is ``(customer_id, segment)``; the overall row has segment ``All``.
    """
    scores = ap_at_k(actual, predicted, k).join(groups, "customer_id", "left")
    both = scores.select(
        "ap", F.explode(F.array(F.lit("All"), F.col("segment").cast("string"))).alias("segment")
    ).where(F.col("segment").isNotNull())
    return both.groupBy("segment").agg(
        F.round(F.avg("ap"), METRIC_DIGITS).alias("map"),
        F.count(F.lit(1)).alias("customers"),
    )


def fill_rate(predicted: DataFrame, k: int = LIST_LENGTH) -> DataFrame:
    """Share of the ``k`` places that are filled, in per cent."""
    filled = F.least(F.size("items"), F.lit(k)) / F.lit(k)
    return predicted.agg(
        F.round(F.round(F.avg(filled), METRIC_DIGITS) * 100, 4).alias("fill"),
        F.count(F.lit(1)).alias("customers"),
    )


def window_sweep(
    tx: DataFrame,
    valid: DataFrame,
    windows: WindowList,
    ref: DateLike,
    k: int = LIST_LENGTH,
) -> DataFrame:
    """Score "history plus popular" for many training windows, which may overlap.

    All windows are scored together. Rows are counted per set of windows that hold
    their day, so that no row is copied before the shuffle, however many windows
    overlap; each customer's counts then go to their windows where they are.
    """
    starts = [as_date(start) for start, _ in windows]
    ends = [as_date(end) for _, end in windows]
    t = F.col("t_dat")
    matching = F.array_compact(
        F.array(
            *[
                F.when((t >= start) & (t < end), i)
                for i, (start, end) in enumerate(zip(starts, ends), start=1)
            ]
        )
    )
    inside = None
    for start, end in zip(starts, ends):
        hit = (t >= start) & (t < end)
        inside = hit if inside is None else inside | hit
    held = tx.where(inside).withColumn("windows", matching)

    counts = held.groupBy("customer_id", "article_id", "windows").agg(
        F.count(F.lit(1)).alias("n"), F.min("t_dat").alias("first_dat")
    )
    spread = counts.repartition("customer_id").withColumn("window_no", F.explode("windows"))
    pair = spread.groupBy("window_no", "customer_id", "article_id").agg(
        F.sum("n").alias("n"), F.min("first_dat").alias("first_dat")
    )
    history = top_per_group(pair, ["window_no", "customer_id"], frequent_first(), k)
    own = history.groupBy("window_no", "customer_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "article_id"))),
            lambda e: e["article_id"],
        ).alias("own")
    )
    daily = held.groupBy("article_id", "t_dat", "windows").agg(F.count(F.lit(1)).alias("n"))
    daily = daily.repartition("article_id").withColumn("window_no", F.explode("windows"))
    scores = daily.groupBy("window_no", "article_id").agg(
        F.round(F.sum(F.col("n") * inverse_days(day_diff(ref, "t_dat"))), SCORE_DIGITS).alias(
            "score"
        )
    )
    popular = to_lists(
        top_per_group(scores, ["window_no"], popular_order(), k), "window_no", k, "popular"
    )
    numbers = F.array(*[F.lit(i) for i in range(1, len(windows) + 1)])
    buyers = valid.select("customer_id").distinct().withColumn("window_no", F.explode(numbers))
    predicted = attach_segment_list(
        buyers.join(own, ["window_no", "customer_id"], "left"),
        popular,
        "window_no",
        max_segments=len(windows),
    ).select("window_no", "customer_id", list_fill("own", "popular", k).alias("items"))
    actual = valid.select(
        F.explode(numbers).alias("window_no"), "customer_id", "article_id"
    )
    return map_at_k(actual, predicted, k, by=["window_no"])


def submission_check(predictions: DataFrame, population: DataFrame) -> DataFrame:
    """Counts that are all zero when there is exactly one row per known customer."""
    per_customer = predictions.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    known = population.select("customer_id").distinct().withColumn("known", F.lit(True))
    return per_customer.join(known, "customer_id", "full").agg(
        F.count_if(F.col("n").isNull()).alias("missing"),
        F.count_if(F.col("known").isNull()).alias("unknown"),
        F.count_if(F.col("n") > 1).alias("repeated"),
    )
