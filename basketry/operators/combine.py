"""From ranked long tables to one list per customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.keys import LIST_LENGTH, ids_to_string
from basketry.functions.lists import list_fill
from basketry.operators.popularity import SCORE_DIGITS
from basketry.operators.skew import attach_segment_list, join_keys, top_per_group


def _ordered(order: str | list[str], item: str = "article_id") -> Column:
    """Items of a group as an array in the order of the given columns."""
    order = [order] if isinstance(order, str) else order
    entries = F.array_sort(F.collect_list(F.struct(*order, F.col(item).alias("_item"))))
    return F.transform(entries, lambda e: e["_item"])


def to_lists(
    ranked: DataFrame, key: str = "customer_id", k: int = LIST_LENGTH, name: str = "items"
) -> DataFrame:
    """One array per key from rows ``(key, rank, article_id)``, cut at ``k`` before grouping."""
    return (
        ranked.where(F.col("rank") <= k).groupBy(key).agg(_ordered("rank").alias(name))
    )


def list_literal(short: DataFrame, k: int = LIST_LENGTH) -> Column:
    """A popular list ``(rank, article_id)`` of at most ``k`` rows as one array value.

    A scalar subquery: the list is computed once and every task gets the value,
    without a join.
    """
    return short.where(F.col("rank") <= k).agg(_ordered("rank")).scalar()


def list_map_literal(ranked: DataFrame, key: str, k: int = LIST_LENGTH) -> Column:
    """Popular lists of a few fixed keys as one map value, computed in one pass."""
    lists = to_lists(ranked, key, k)
    return lists.agg(F.map_from_entries(F.collect_list(F.struct(key, "items")))).scalar()


def population_lists(
    population: DataFrame,
    lists: DataFrame,
    popular: Column,
    k: int = LIST_LENGTH,
    dedup: bool = False,
) -> DataFrame:
    """Everyone in the population with their own list filled up to ``k``."""
    return population.select("customer_id").join(lists, "customer_id", "left").select(
        "customer_id", list_fill("items", popular, k, dedup).alias("items")
    )


def to_predictions(lists: DataFrame, items: str = "items") -> DataFrame:
    return lists.select("customer_id", ids_to_string(items).alias("prediction"))


def attach_predictions(population: DataFrame, predictions: DataFrame) -> DataFrame:
    """Predictions for the whole population, the empty string where there is none."""
    return population.select("customer_id").join(predictions, "customer_id", "left").select(
        "customer_id", F.coalesce("prediction", F.lit("")).alias("prediction")
    )


def segment_items(
    segments: DataFrame, popular: DataFrame, max_segments: int | None = None, flag: str | None = None
) -> DataFrame:
    """Each customer with the popular list of their segment: ``customer_id, rank, article_id``.

    ``flag`` is a column of ``popular`` that goes along.
    """
    carried = [flag] if flag else []
    short = popular.where(F.col("rank") <= LIST_LENGTH)
    lists = short.groupBy("segment").agg(F.array_sort(F.collect_list(F.struct("rank", "article_id", *carried))).alias("items"))
    attached = attach_segment_list(segments, lists, "segment", max_segments)
    return attached.select("customer_id", F.posexplode("items").alias("_pos", "_item")).select(
        "customer_id", (F.col("_pos") + 1).cast("bigint").alias("rank"), *[F.col(f"_item.{c}").alias(c) for c in ("article_id", *carried)]
    )


def blend(
    lists: list[DataFrame], weights: list[float] | None = None, k: int = LIST_LENGTH, flag: str | None = None
) -> DataFrame:
    """Weighted reciprocal-rank blend of ranked long lists.

    An item scores ``weight / rank`` in every place it appears; lists with a
    negative weight are left out. Ties go to the item that appears first, in the
    order of the lists. Columns: ``customer_id, rank, article_id, score``, and
    ``flag``, a column of all lists, which is the same for an item wherever it appears.
    """
    carried = [flag] if flag else []
    weights = weights or [1.0] * len(lists)
    # List number and rank in one number: the first place sorts and aggregates as a long.
    parts = [
        ranked.select(
            "customer_id",
            "article_id",
            (F.lit(i << 40) + F.col("rank")).alias("_place"),
            (F.lit(float(weight)) / F.col("rank")).alias("_part"),
            *carried,
        )
        for i, (ranked, weight) in enumerate(zip(lists, weights))
        if weight >= 0
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    # Hardly any row has a partner in its own task, so sums before the shuffle would only take memory.
    rows = rows.repartition("customer_id", "article_id")
    scores = rows.groupBy("customer_id", "article_id").agg(
        F.round(F.sum("_part"), SCORE_DIGITS).alias("score"),
        F.min("_place").alias("_first"),
        *[F.max(c).alias(c) for c in carried],
    )
    order = [F.desc("score"), F.asc("_first")]
    return top_per_group(scores, ["customer_id"], order, k).select(
        "customer_id", "rank", "article_id", "score", *carried
    )


def prune(ranked: DataFrame, allowed: DataFrame, k: int = LIST_LENGTH) -> DataFrame:
    """First ``k`` different items of each list that are in ``allowed``."""
    first = ranked.groupBy("customer_id", "article_id").agg(F.min("rank").alias("_old"))
    kept = join_keys(first, allowed, ["article_id"])
    return top_per_group(kept, ["customer_id"], [F.asc("_old")], k).select(
        "customer_id", "rank", "article_id"
    )


def pruned_lists(ranked: DataFrame, flag: str, k: int = LIST_LENGTH, name: str = "items") -> DataFrame:
    """One array per customer of the first ``k`` items whose ``flag`` is true, from a blend's rows.

    The rows are grouped as the blend left them, without another shuffle.
    """
    entries = F.array_sort(F.collect_list(F.struct("rank", "article_id", flag)))
    kept = F.transform(F.filter(entries, lambda e: e[flag]), lambda e: e["article_id"])
    return ranked.groupBy("customer_id").agg(F.slice(kept, 1, k).alias(name))


def list_length_hist(lists: DataFrame, items: str = "items") -> DataFrame:
    return lists.groupBy(F.size(items).cast("bigint").alias("length")).agg(
        F.count(F.lit(1)).alias("n")
    )
