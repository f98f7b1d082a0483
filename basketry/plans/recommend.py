"""The recommenders. Each returns ``customer_id, items`` with at most ``k`` items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.dates import DateLike, as_date, in_window
from basketry.functions.keys import LIST_LENGTH
from basketry.functions.lists import list_fill
from basketry.operators import factor, popularity
from basketry.operators.combine import (
    blend,
    list_literal,
    list_map_literal,
    population_lists,
    pruned_lists,
    segment_items,
    to_lists,
)
from basketry.operators.history import (
    customer_article_counts,
    frequent_first,
    history_items,
    last_purchase_items,
    last_week_items,
    stacked_history,
)
from basketry.operators.popularity import popular_items
from basketry.operators.related import alternates, renumbered, still_sold
from basketry.operators.skew import attach_segment_list, join_totals, many_partitions, top_per_group
from basketry.operators.trend import trend_items, trend_popular
from basketry.operators.windows import (
    WindowList,
    numbered_windows,
    trailing_window,
)
from basketry.sources.lineage import cut_lineage


def popular_literal(
    tx: DataFrame,
    start: DateLike,
    end: DateLike,
    k: int = LIST_LENGTH,
    decay: str = "inverse",
    dedup: bool = False,
) -> Column:
    """The decayed popular list of a window as one array value.

    A fill that skips items the customer already has needs up to ``k`` spares.
    """
    size = 2 * k if dedup else k
    return list_literal(popular_items(tx, start, end, k=size, decay=decay), size)


def top12(tx: DataFrame, population: DataFrame, k: int = LIST_LENGTH) -> DataFrame:
    """The articles with most buyers, the same for everyone."""
    best = popularity.top_k_global(popularity.distinct_buyers(tx), k)
    return population.select("customer_id", list_literal(best, k).alias("items"))


def history_fill(
    tx: DataFrame,
    population: DataFrame,
    start: DateLike,
    end: DateLike,
    k: int = LIST_LENGTH,
    decay: str = "inverse",
    dedup: bool = False,
) -> DataFrame:
    """A customer's own articles of the window, then the popular ones."""
    own = to_lists(history_items(tx, start, end, k), k=k)
    return population_lists(
        population, own, popular_literal(tx, start, end, k, decay, dedup), k, dedup
    )


def _first_tier(
    tx: DataFrame, windows: WindowList, cuts: list[int]
) -> DataFrame:
    """Per customer the first window with purchases and its ranked articles: ``tier, items``.

    Tier ``i`` keeps ``cuts[i]`` articles. Every customer brings at most
    ``sum(cuts)`` rows to the grouping.
    """
    counts = customer_article_counts(numbered_windows(tx, windows), ["window_no"])
    ranks = top_per_group(
        counts, ["customer_id", "window_no"], frequent_first(), max(cuts)
    )
    allowed = F.element_at(F.array(*[F.lit(c) for c in cuts]), F.col("window_no"))
    kept = ranks.where(F.col("rank") <= allowed)
    return kept.groupBy("customer_id").agg(
        F.min("window_no").alias("tier"),
        F.array_sort(F.collect_list(F.struct("window_no", "rank", "article_id"))).alias("_all"),
    ).select(
        "customer_id",
        "tier",
        F.transform(
            F.filter("_all", lambda e: e["window_no"] == F.col("tier")),
            lambda e: e["article_id"],
        ).alias("items"),
    )


def two_tier(
    tx: DataFrame,
    population: DataFrame,
    recent: tuple[DateLike, DateLike],
    older: tuple[DateLike, DateLike],
    older_cut: int = 4,
    k: int = LIST_LENGTH,
    dedup: bool = False,
) -> DataFrame:
    """Recent articles if there are any, else a few older ones, then the recent popular ones."""
    own = _first_tier(tx, [recent, older], [k, older_cut]).drop("tier")
    return population_lists(
        population, own, popular_literal(tx, *recent, k=k, dedup=dedup), k, dedup
    )


def three_tier(
    tx: DataFrame,
    population: DataFrame,
    windows: WindowList,
    fallback_tier: int = 2,
    k: int = LIST_LENGTH,
) -> DataFrame:
    """The newest window with purchases, filled with the best sellers up to that window.

    ``windows`` are neighbours, newest first. Tier ``i`` is filled from windows
    ``1 .. i`` together; customers in no window get the list of ``fallback_tier``.
    """
    own = _first_tier(tx, windows, [k] * len(windows))
    window_counts = popularity.article_counts(numbered_windows(tx, windows), ["window_no"])
    reached = F.sequence(F.col("window_no"), F.lit(len(windows)))
    sold = (
        window_counts.withColumn("tier", F.explode(reached))
        .groupBy("tier", "article_id")
        .agg(F.sum("n").alias("n"))
    )
    best = top_per_group(sold, ["tier"], [F.desc("n"), F.asc("article_id")], k)
    fill = F.element_at(
        list_map_literal(best, "tier", k), F.coalesce("tier", F.lit(fallback_tier))
    )
    return population.select("customer_id").join(own, "customer_id", "left").select(
        "customer_id", list_fill("items", fill, k).alias("items")
    )


def stacked(
    tx: DataFrame,
    population: DataFrame,
    windows: WindowList,
    popular_windows: int = 2,
    k: int = LIST_LENGTH,
    dedup: bool = False,
) -> DataFrame:
    """Articles of several windows, newest first, then the popular ones of the newest windows."""
    own = to_lists(stacked_history(tx, windows, k, dedup), k=k)
    start, end = windows[popular_windows - 1][0], windows[0][1]
    return population_lists(
        population, own, popular_literal(tx, start, end, k, dedup=dedup), k, dedup
    )


def stacked_alternate_items(
    tx: DataFrame,
    articles: DataFrame,
    windows: WindowList,
    factor: float = 2,
    price_rule: bool = False,
    name_col: str = "prod_name",
    single_sibling_only: bool = False,
    lag: int = 1,
    k: int = LIST_LENGTH,
    dedup: bool = False,
) -> DataFrame:
    """Each window's articles followed by their better selling siblings: ``customer_id, rank, article_id``.

    ``windows`` has ``lag`` windows more than are used for the lists: the siblings
    for window ``i`` come from the sales of window ``i + lag``.
    """
    lists = windows[: len(windows) - lag] if lag else windows
    counts = customer_article_counts(numbered_windows(tx, lists), ["window_no"])
    ranks = top_per_group(counts, ["customer_id", "window_no"], frequent_first(), k)
    own = ranks.select("customer_id", "window_no", F.lit(0).alias("_part"), "rank", "article_id")
    better = alternates(
        numbered_windows(tx, windows),
        articles,
        factor,
        price_rule,
        name_col,
        single_sibling_only,
        by=["window_no"],
    ).select(
        (F.col("window_no") - lag).alias("window_no"), "article_id", "next_best_article"
    )
    extra = join_totals(own, better, ["window_no", "article_id"]).select(
        "customer_id",
        "window_no",
        F.lit(1).alias("_part"),
        "rank",
        F.col("next_best_article").alias("article_id"),
    )
    rows = own.unionByName(extra)
    place = F.struct("window_no", "_part", F.col("rank").alias("_rank"), "article_id")
    if dedup:
        rows = rows.groupBy("customer_id", "article_id").agg(F.min(place).alias("_place"))
    else:
        rows = rows.select("customer_id", "article_id", place.alias("_place"))
    return top_per_group(rows, ["customer_id"], [F.asc("_place")], k).select(
        "customer_id", "rank", "article_id"
    )


def stacked_alternates(
    tx: DataFrame,
    articles: DataFrame,
    population: DataFrame,
    windows: WindowList,
    popular_windows: int = 2,
    k: int = LIST_LENGTH,
    dedup: bool = False,
    **options,
) -> DataFrame:
    """Stacked history with alternates, then the popular articles of the newest windows.

    The rows of the windows are read once and written to the checkpoint folder.
    """
    tx = cut_lineage(numbered_windows(tx, windows).select("t_dat", "customer_id", "article_id", "price"))
    own = to_lists(
        stacked_alternate_items(tx, articles, windows, k=k, dedup=dedup, **options), k=k
    )
    start, end = windows[popular_windows - 1][0], windows[0][1]
    return population_lists(
        population, own, popular_literal(tx, start, end, k, dedup=dedup), k, dedup
    )


# The sales channels that have a list of their own.
CHANNELS = (1, 2)


def channel_fill(
    tx: DataFrame,
    articles: DataFrame,
    population: DataFrame,
    windows: WindowList,
    popular_windows: int = 2,
    k: int = LIST_LENGTH,
    dedup: bool = False,
    channels: tuple[int, ...] = CHANNELS,
    **options,
) -> DataFrame:
    """Stacked history with alternates, then the popular articles of the customer's channel.

    The lowest of ``channels`` the customer has a row in; customers of none of
    them get the popular articles of all rows, whatever their channel. The rows of
    the windows are read once and written to the checkpoint folder; lists, siblings,
    popular articles and channels all start from there.
    """
    columns = ("t_dat", "customer_id", "article_id", "price", "sales_channel_id")
    tx = cut_lineage(numbered_windows(tx, windows).select(*columns))
    own = to_lists(
        stacked_alternate_items(tx, articles, windows, k=k, dedup=dedup, **options), k=k
    )
    start, end = windows[popular_windows - 1][0], windows[0][1]
    size = 2 * k if dedup else k
    known = tx.where(F.col("sales_channel_id").isin(*channels))
    lists = to_lists(
        popular_items(known, start, end, k=size, by="sales_channel_id"), "sales_channel_id", size, "fill"
    ).withColumnRenamed("sales_channel_id", "channel")
    channel = (
        known.where(in_window("t_dat", start, end))
        .groupBy("customer_id")
        .agg(F.min("sales_channel_id").alias("channel"))
    )
    rows = (
        population.select("customer_id")
        .join(own, "customer_id", "left")
        .join(channel, "customer_id", "left")
    )
    fill = F.coalesce("fill", popular_literal(tx, start, end, size, dedup=False))
    return attach_segment_list(rows, lists, "channel", len(channels)).select(
        "customer_id", list_fill("items", fill, k, dedup).alias("items")
    )


def trend(
    tx: DataFrame,
    population: DataFrame,
    last: DateLike,
    days: int = 7,
    k: int = LIST_LENGTH,
) -> DataFrame:
    """Articles scored by weekly trend and decay, then the strongest trends overall."""
    general = popularity.ranked(
        trend_popular(tx, last, k, days), [F.desc("score"), F.asc("article_id")]
    )
    own = to_lists(trend_items(tx, last, k, days), k=k)
    return population_lists(population, own, list_literal(general, k), k)


def last_week_pair_items(
    tx: DataFrame, pairs: DataFrame, within_days: int = 6, k: int = LIST_LENGTH
) -> DataFrame:
    """The customer's own last week, then what goes with it, each article once."""
    own = last_week_items(tx, within_days, k).select("customer_id", "rank", "article_id")
    paired = join_totals(own, pairs.select("article_id", "article_id2"), ["article_id"]).select(
        "customer_id", (F.col("rank") + k).alias("rank"), F.col("article_id2").alias("article_id")
    )
    rows = own.unionByName(paired).groupBy("customer_id", "article_id").agg(
        F.min("rank").alias("_place")
    )
    return top_per_group(rows, ["customer_id"], [F.asc("_place")], k).select(
        "customer_id", "rank", "article_id"
    )


def last_week_pairs(
    tx: DataFrame,
    population: DataFrame,
    pairs: DataFrame,
    last: DateLike,
    days: int = 6,
    k: int = LIST_LENGTH,
) -> DataFrame:
    """Own last week, then paired articles, then the best sellers of the final days."""
    best = popularity.top_k_global(
        popularity.article_counts(trailing_window(tx, last, days)), k
    )
    own = to_lists(last_week_pair_items(tx, pairs, days, k), k=k)
    return population_lists(population, own, list_literal(best, k), k)


def als(
    tx: DataFrame,
    population: DataFrame,
    settings: factor.FactorSettings = factor.FactorSettings(),
    k: int = LIST_LENGTH,
) -> DataFrame:
    """Implicit-feedback matrix factorisation."""
    return factor.als_lists(tx, population, settings, k)


def mf_rerank(
    tx: DataFrame,
    population: DataFrame,
    start: DateLike,
    end: DateLike,
    k: int = LIST_LENGTH,
    **options,
) -> DataFrame:
    """Own articles re-ranked by biased matrix factorisation, then the popular ones."""
    own = to_lists(factor.mf_reranked_items(tx, start, end, k=k, **options), k=k)
    return population_lists(population, own, popular_literal(tx, start, end, k), k)


# Fixed values of the blend: weights of last purchases, variants and each
# segment list, length before pruning, and days an article may go unsold.
BLEND_WEIGHTS = (100.0, 10.0, 1.0, 1.0)
BLEND_LENGTH = 32
SOLD_WITHIN_DAYS = 11


def blended(
    tx: DataFrame,
    articles: DataFrame,
    customers: DataFrame,
    population: DataFrame,
    last: DateLike,
    by_channel: bool = True,
    by_age: bool = True,
    purchase_days: int = 14,
    variant_days: int = 6,
    segment_days: int = 4,
    sold_days: int = SOLD_WITHIN_DAYS,
    k: int = LIST_LENGTH,
) -> DataFrame:
    """Blend of last purchases, their variants and segment best sellers, pruned to what still sells.

    Whether an article still sells is one flag per article, from a single table of
    the trailing days. Lists get it with the lookup of variants, or while they are
    still short, and carry it through the blend. Shuffles of the session begin with
    ``skew.PARTITIONS`` partitions from here on.
    """
    many_partitions(tx.sparkSession)
    past = tx.where(F.col("t_dat") <= as_date(last))
    bought = last_purchase_items(past, purchase_days).select("customer_id", "rank", "article_id")
    # Read twice below, and the only part that needs every row of the past.
    bought = cut_lineage(
        bought.join(population.select("customer_id"), "customer_id", "left_semi")
    )
    selling = cut_lineage(still_sold(past, articles, last, sold_days, variant_days))
    looked_up = cut_lineage(join_totals(bought, selling, ["article_id"], "left"))
    mapped = looked_up.where(F.col("variant_id").isNotNull())
    lists = [
        looked_up.select("customer_id", "rank", "article_id", F.coalesce("sold", F.lit(False)).alias("sold")),
        renumbered(mapped.select("customer_id", "rank", F.col("variant_id").alias("article_id"), F.col("variant_sold").alias("sold"))),
    ]

    def flagged(best: DataFrame) -> DataFrame:
        known = best.join(selling.select("article_id", "sold"), "article_id", "left")
        return known.withColumn("sold", F.coalesce("sold", F.lit(False)))

    if by_channel:
        groups = popularity.population_channel_group(population, tx)
        best = popularity.segment_popular(past, groups, last, segment_days, k)
        lists.append(segment_items(groups, flagged(best), flag="sold"))
    if by_age:
        groups = popularity.age_group(customers).join(
            population.select("customer_id"), "customer_id", "left_semi"
        )
        best = popularity.segment_popular(
            past, popularity.age_group(customers), last, segment_days, k
        )
        lists.append(segment_items(groups, flagged(best), max_segments=len(popularity.AGE_EDGES), flag="sold"))
    lists = pruned_lists(blend(lists, list(BLEND_WEIGHTS[: len(lists)]), BLEND_LENGTH, "sold"), "sold", k)
    return population.select("customer_id").join(lists, "customer_id", "left").select(
        "customer_id", list_fill("items", F.array().cast("array<string>"), k).alias("items")
    )
