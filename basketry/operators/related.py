"""Articles related to other articles: siblings, colour variants, bought together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.dates import DateLike, as_date, week_bucket
from basketry.operators.popularity import article_counts, article_stats
from basketry.operators.skew import join_keys, join_totals, many_partitions, numbered, positions, top_per_group
from basketry.operators.windows import trailing_window
from basketry.sources.lineage import cut_lineage

# Partners of a basket that the first round tries; every later round goes so many times as deep.
FIRST_DEPTH, DEEPER = 64, 4
# Positions per bucket when a mapped list is renumbered.
LIST_BUCKET = 1000


def best_other_in_group(
    counts: DataFrame, groups: DataFrame, group_col: str, by: list[str] | None = None
) -> DataFrame:
    """For each counted article the best seller among the others of its group.

    ``counts`` has ``article_id``, ``article_count`` and ``article_min_price``,
    ``groups`` maps articles to ``group_col``. The best other article is the
    second of the group for the group's leader and the leader for everyone else,
    so two rows per group answer for all of its members and no pairs are built.
    Adds the struct ``other`` (null where the group has no other sold article).
    """
    keys = [*(by or []), group_col]
    member = counts.join(groups.select("article_id", group_col), "article_id")
    leaders = top_per_group(
        member, keys, [F.desc("article_count"), F.asc("article_id")], 2
    )
    entry = F.struct("article_id", "article_count", "article_min_price")
    pair = leaders.groupBy(*keys).agg(
        F.max(F.when(F.col("rank") == 1, entry)).alias("_first"),
        F.max(F.when(F.col("rank") == 2, entry)).alias("_second"),
    )
    is_leader = F.col("_first.article_id") == F.col("article_id")
    return (
        join_totals(member, pair, keys)
        .withColumn("other", F.when(is_leader, F.col("_second")).otherwise(F.col("_first")))
        .drop("_first", "_second")
    )


def siblings(
    tx: DataFrame, articles: DataFrame, name_col: str = "prod_name"
) -> DataFrame:
    """Number of other catalogue articles of the same name, and the best seller among them.

    Articles without a sale count zero, so that every catalogue article appears.
    """
    sold = article_stats(tx)
    catalogue = articles.select("article_id", name_col)
    counts = catalogue.select("article_id").join(sold, "article_id", "left").select(
        "article_id",
        F.coalesce("article_count", F.lit(0).cast("bigint")).alias("article_count"),
        "article_min_price",
    )
    sizes = catalogue.groupBy(name_col).agg(F.count(F.lit(1)).alias("_size"))
    best = best_other_in_group(counts, catalogue, name_col)
    return join_totals(best, sizes, [name_col]).select(
        "article_id",
        (F.col("_size") - 1).alias("n_siblings"),
        F.col("other.article_id").alias("best_sibling"),
        F.col("other.article_count").alias("best_sibling_count"),
    )


def alternates(
    tx: DataFrame,
    articles: DataFrame,
    factor: float = 2,
    price_rule: bool = False,
    name_col: str = "prod_name",
    single_sibling_only: bool = False,
    by: list[str] | None = None,
) -> DataFrame:
    """Sold articles with a much better selling sibling: ``article_id, next_best_article, ...``.

    A sibling qualifies when it sells more than ``factor`` times as often; with
    ``price_rule`` also only when it is not dearer. ``single_sibling_only`` keeps
    articles that have exactly one sibling in the catalogue.
    """
    best = best_other_in_group(article_stats(tx, by), articles, name_col, by)
    rule = F.col("other.article_count") > F.lit(factor) * F.col("article_count")
    if price_rule:
        rule = rule & (F.col("article_min_price") >= F.col("other.article_min_price"))
    if single_sibling_only:
        sizes = articles.groupBy(name_col).agg(F.count(F.lit(1)).alias("_size"))
        best = join_totals(best, sizes, [name_col]).where(F.col("_size") == 2)
    return best.where(rule).select(
        *(by or []),
        "article_id",
        F.col("other.article_id").alias("next_best_article"),
        "article_count",
        F.col("other.article_count").alias("next_best_count"),
    )


def variant_map(
    tx: DataFrame, articles: DataFrame, last: DateLike, days: int = 6
) -> DataFrame:
    """Sold article to the best-selling other article of its product in the trailing window."""
    return _variants(article_counts(trailing_window(tx, last, days)), articles)


def _variants(sold: DataFrame, articles: DataFrame) -> DataFrame:
    counts = sold.select(
        "article_id",
        F.col("n").alias("article_count"),
        F.lit(None).cast("double").alias("article_min_price"),
    )
    best = best_other_in_group(counts, articles, "product_code")
    return best.where(F.col("other").isNotNull()).select(
        "article_id", F.col("other.article_id").alias("variant_id")
    )


def map_list(items: DataFrame, mapping: DataFrame, to: str) -> DataFrame:
    """Replace every list item by its image; items without one drop out, order stays.

    ``items`` is ``(customer_id, rank, article_id)`` with lists of any length.
    """
    mapped = join_totals(items, mapping, ["article_id"]).select("customer_id", "rank", F.col(to).alias("article_id"))
    return renumbered(mapped).select("customer_id", "rank", "article_id")


def renumbered(items: DataFrame) -> DataFrame:
    """Lists ``(customer_id, rank, ...)`` of any length with gaps in their ranks closed."""
    gapped = items.withColumnRenamed("rank", "_old")
    buckets = {"_bucket": F.floor(F.col("_old") / LIST_BUCKET)}
    return positions(gapped, ["customer_id"], buckets, [F.asc("_old")]).drop("_old")


def still_sold(tx: DataFrame, articles: DataFrame, last: DateLike, sold_days: int, variant_days: int) -> DataFrame:
    """``article_id, sold, variant_id, variant_sold`` of the articles of the trailing days, from one pass.

    ``sold`` and ``variant_sold`` say whether the article and its best-selling variant
    were sold in the last ``sold_days`` days; the variant is chosen by the sales of
    ``variant_days``.
    """
    last_day = as_date(last)
    trail = cut_lineage(
        trailing_window(tx, last, max(sold_days, variant_days)).groupBy("article_id").agg(
            F.max(F.col("t_dat") >= F.date_sub(last_day, sold_days)).alias("sold"),
            F.count_if(F.col("t_dat") >= F.date_sub(last_day, variant_days)).alias("n"),
        )
    )
    chosen = _variants(trail.where("n > 0"), articles)
    of_variant = trail.select(F.col("article_id").alias("variant_id"), F.col("sold").alias("variant_sold"))
    return trail.drop("n").join(join_totals(chosen, of_variant, ["variant_id"]), "article_id", "left")


def variant_items(
    last_items: DataFrame, tx: DataFrame, articles: DataFrame, last: DateLike, days: int = 6
) -> DataFrame:
    """The customer's last purchases, each replaced by its best-selling variant."""
    return map_list(last_items, variant_map(tx, articles, last, days), "variant_id")


def copurchase_pairs(tx: DataFrame, last: DateLike, days: int = 7) -> DataFrame:
    """For each article the article that shares most baskets with it: ``article_id, article_id2, n``.

    A basket holds the different articles of one customer in one bucket of
    ``days`` days. Ties go to the article that is in more baskets, then to the
    lower id; in that order every basket offers its articles as partners.

    A threshold algorithm in rounds, each ``DEEPER`` times as deep as the one
    before: the articles still open meet the next partners of their baskets. After
    a round a partner's count can grow by the number of the article's baskets
    that go deeper, and no partner shares more baskets than it is in. The article is
    closed once neither another partner that was met nor the next one on offer
    can pass the best. Baskets no deeper than the first round are paired in full,
    once for both directions. Each round's tables are written to the checkpoint
    folder while the plan is made; the deepest basket gives the number of rounds.
    Articles are known by their number in the order of ties, so that pairs are two
    numbers and a partner's rank is one, with its count.
    """
    many_partitions(tx.sparkSession)
    basket = ["customer_id", "week_end"]
    rows = tx.select("customer_id", week_bucket("t_dat", last, days).alias("week_end"), "article_id").distinct()
    sizes = rows.groupBy(*basket).agg(F.count(F.lit(1)).alias("size"))
    rows = cut_lineage(join_totals(rows, sizes, basket))
    common = rows.where("article_id IS NOT NULL").groupBy("article_id").agg(F.count(F.lit(1)).alias("baskets"), F.max("size").alias("deepest"))
    common = numbered(common.withColumn("_all", F.lit(0)), ["_all"], [F.desc("baskets"), F.asc("article_id")], "number").drop("_all")
    named = cut_lineage(common)
    common = named.select(F.col("number").alias("article_id"), "baskets", "deepest")
    deepest = common.agg(F.max("deepest")).first()[0] or 0
    rows = join_totals(rows.where("size > 1"), named.select("article_id", "number"), ["article_id"])
    rows = cut_lineage(rows.select(*basket, F.col("number").alias("article_id"), "size"))

    small = rows.where(F.col("size").between(2, FIRST_DEPTH))
    found = _both_ways(small, basket)
    done = None
    if deepest > FIRST_DEPTH:
        deep = join_totals(rows.where(F.col("size") > FIRST_DEPTH), common.select("article_id", "baskets"), ["article_id"])
        deep = numbered(deep, basket, [F.desc("baskets"), F.asc("article_id")], "place")
        open_rows, low, high = deep, 0, FIRST_DEPTH
        while True:
            met = _meet(open_rows, deep, basket, low, high).groupBy("article_id", "article_id2").agg(F.count(F.lit(1)).alias("n"))
            found = found.unionByName(met).groupBy("article_id", "article_id2").agg(F.sum("n").alias("n"))
            if high >= deepest:
                break
            found = cut_lineage(found)
            judged = cut_lineage(_judged(_with_baskets(found, common), open_rows, deep, basket, high))
            closed = judged.where("closed").select("article_id", "best.*")
            done = closed if done is None else done.unionByName(closed)
            found = join_keys(found, closed, ["article_id"], "left_anti")
            open_rows = cut_lineage(join_keys(open_rows.where(F.col("size") > high), closed, ["article_id"], "left_anti"))
            low, high = high, high * DEEPER
    # the largest count, then the smallest number, in one number that a hash aggregate holds
    best = F.max(F.shiftleft("n", 32) - F.col("article_id2")).alias("_best")
    number = (F.shiftleft(F.lit(1).cast("bigint"), 32) - F.col("_best").bitwiseAND(0xFFFFFFFF)) % (1 << 32)
    rest = found.groupBy("article_id").agg(best).select(
        "article_id", number.alias("article_id2"), (-F.shiftright(F.col("_best") + number, 32)).alias("n")
    )
    result = rest if done is None else done.select("article_id", "article_id2", "n").unionByName(rest)
    of = named.select(F.col("number").alias("article_id"), F.col("article_id").alias("_name"))
    partner = of.select(F.col("article_id").alias("article_id2"), F.col("_name").alias("_name2"))
    result = join_totals(join_totals(result, of, ["article_id"]), partner, ["article_id2"])
    return result.select(F.col("_name").alias("article_id"), F.col("_name2").alias("article_id2"), (-F.col("n")).alias("n"))


def _both_ways(small: DataFrame, basket: list[str]) -> DataFrame:
    """Shared baskets of every two articles of whole baskets, counted once and given in both directions."""
    other = small.select(*basket, F.col("article_id").alias("article_id2"))
    once = small.select(*basket, "article_id").join(other, basket).where(F.col("article_id") < F.col("article_id2"))
    counted = once.groupBy("article_id", "article_id2").agg(F.count(F.lit(1)).alias("n"))
    ways = F.array(
        F.struct("article_id", "article_id2"),
        F.struct(F.col("article_id2").alias("article_id"), F.col("article_id").alias("article_id2")),
    )
    return counted.select(F.explode(ways).alias("way"), "n").select("way.*", "n")


def _meet(open_rows: DataFrame, deep: DataFrame, basket: list[str], low: int, high: int) -> DataFrame:
    """Open articles with the partners at the places ``low + 1 .. high`` of their baskets."""
    offered = deep.where((F.col("place") > low) & (F.col("place") <= high)).select(*basket, F.col("article_id").alias("article_id2"))
    return open_rows.select(*basket, "article_id").join(offered, basket).where(F.col("article_id") != F.col("article_id2")).select("article_id", "article_id2")


def _with_baskets(found: DataFrame, common: DataFrame) -> DataFrame:
    """Pairs with the number of baskets that the partner is in."""
    partner = common.select(F.col("article_id").alias("article_id2"), "baskets")
    return join_totals(found, partner, ["article_id2"])


def _partner_order(n: str = "n") -> Column:
    return F.struct((-F.col(n)).alias("n"), (-F.col("baskets")).alias("baskets"), "article_id2")


def _judged(found: DataFrame, open_rows: DataFrame, deep: DataFrame, basket: list[str], high: int) -> DataFrame:
    """``article_id, best, closed`` of the articles with a partner, ``best`` as a ``_partner_order``."""
    offer = deep.where(F.col("place") == high + 1).select(
        *basket, F.struct((-F.col("baskets")).alias("baskets"), F.col("article_id").alias("article_id2")).alias("offer")
    )
    deeper = open_rows.where(F.col("size") > high).join(offer, basket)
    reach = deeper.groupBy("article_id").agg(F.count(F.lit(1)).alias("reach"), F.min("offer").alias("offer"))
    seen = join_totals(found, reach, ["article_id"], "left").withColumn(
        "most", F.least(F.col("n") + F.coalesce("reach", F.lit(0)), "baskets")
    )
    judged = seen.groupBy("article_id").agg(
        F.min(_partner_order()).alias("best"), F.min(_partner_order("most")).alias("rival"), F.max("reach").alias("reach"), F.max("offer").alias("offer")
    )
    coming = F.struct((-F.least("reach", -F.col("offer.baskets"))).alias("n"), F.col("offer.baskets").alias("baskets"), F.col("offer.article_id2").alias("article_id2"))
    closed = F.col("reach").isNull() | ((F.col("rival") == F.col("best")) & (F.col("best") < coming))
    return judged.select("article_id", "best", closed.alias("closed"))
