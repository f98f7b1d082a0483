"""Joins and positions that stay balanced when one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.sources.lineage import cut_lineage


#: Partitions that a shuffle of all purchases begins with, and the size up to which adaptive execution joins them.
PARTITIONS, PARTITIONS_SETTING = 1024, "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
JOINED_SIZE, JOINED_SIZE_SETTING = "16m", "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def many_partitions(spark: SparkSession) -> None:
    """Let shuffles of the session begin with ``PARTITIONS`` partitions, unless it has its own number.

    With a fixed few, a task's rows, and with them its sorts and aggregates, grow
    with the input. Adaptive execution joins small neighbours up to ``JOINED_SIZE``
    (or the session's own size), so that a task gets as much whatever the input. For plans that run later too, the settings stay.
    """
    if spark.conf.get(JOINED_SIZE_SETTING, None) is None:
        spark.conf.set(JOINED_SIZE_SETTING, JOINED_SIZE)
    if spark.conf.get(PARTITIONS_SETTING, None) is None:
        own = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set(PARTITIONS_SETTING, max(PARTITIONS, own))


def join_totals(
    rows: DataFrame, totals: DataFrame, keys: list[str], how: str = "inner"
) -> DataFrame:
    """Join ``rows`` to a table aggregated per key (max date, count, ...).

    Joined on the keys alone, the aggregate is already partitioned for the join
    and has no exchange of its own, and adaptive execution splits a hot
    partition only between two exchanges. The hash of the keys as one more join
    column gives the small side that exchange; the result is the same. This needs
    ``spark.sql.requireAllClusterKeysForCoPartition`` at its default, true.
    """
    spread = F.xxhash64(*keys)
    return (
        rows.withColumn("_spread", spread)
        .join(totals.withColumn("_spread", spread), [*keys, "_spread"], how)
        .drop("_spread")
    )


def join_keys(rows: DataFrame, keys_of: DataFrame, keys: list[str], how: str = "left_semi") -> DataFrame:
    """``rows`` whose keys ``keys_of`` has (``left_semi``) or lacks (``left_anti``).

    The right side is reduced to its different keys before it is shuffled, and a
    hot key of ``rows`` is split as in ``join_totals``.
    """
    return join_totals(rows, keys_of.select(*keys).distinct(), keys, how)


def top_per_group(
    rows: DataFrame, group: list[str], order: list[Column], k: int, name: str = "rank"
) -> DataFrame:
    """First ``k`` rows of each group with their 1-based rank.

    The filter on the rank lets Spark cut every group to ``k`` rows on the map
    side, so a hot group sends at most ``k`` rows per task. Spark does so for ``k``
    up to ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000 by default); use
    ``numbered`` for longer lists of hot groups.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def numbered(
    rows: DataFrame,
    group: list[str],
    order: list[Column],
    name: str = "rank",
    weight: str | None = None,
) -> DataFrame:
    """1-based position of every row in its group, for groups of any length.

    A prefix sum in two passes. Rows are dealt to ranges of (group, order), which a
    sample makes equally large whatever the groups, and numbered within range and
    group. Only a range's first group can have begun before it, so one number for
    each range, the rows of that group in earlier ranges, shifts them into place.
    With ``weight`` a row stands for that many neighbouring rows and gets the
    position of the first of them. The numbered ranges are written to the
    checkpoint folder while the plan is made.
    """
    placed = cut_lineage(numbered_in_parts(rows, group, order, "_within", weight))
    last = F.col("_within") + F.col(weight) - 1 if weight else F.col("_within")
    parts = placed.groupBy("_part").agg(
        F.min(F.struct(*group)).alias("first"), F.max(F.struct(*group, last.alias("_rows"))).alias("end")
    )
    begun = parts.select(*[F.col(f"first.{g}").alias(f"_{g}") for g in group], "_part", F.lit(0).alias("_kind"), F.lit(0).alias("_rows"))
    ended = parts.select(*[F.col(f"end.{g}").alias(f"_{g}") for g in group], "_part", F.lit(1).alias("_kind"), F.col("end._rows"))
    earlier = Window.partitionBy(*[f"_{g}" for g in group]).orderBy("_part", "_kind").rowsBetween(Window.unboundedPreceding, -1)
    shift = begun.unionByName(ended).withColumn("_before", F.sum("_rows").over(earlier)).where((F.col("_kind") == 0) & (F.col("_before") > 0))
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    # at most one row for each range
    joined = placed.join(F.broadcast(shift.drop("_kind", "_rows")), "_part", "left")
    before = F.when(same, F.col("_before")).otherwise(0)
    return joined.select(*rows.columns, (F.col("_within") + F.coalesce(before, F.lit(0))).cast("bigint").alias(name))


def numbered_in_parts(rows: DataFrame, group: list[str], order: list[Column], name: str, weight: str | None = None) -> DataFrame:
    """Rows with the number of their range of (group, order), ``_part``, and their position in range and group."""
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(ranges, *[F.col(g) for g in group], *order).withColumn("_part", F.spark_partition_id())
    inside = Window.partitionBy("_part", *group).orderBy(*order)
    if not weight:
        return dealt.withColumn(name, F.row_number().over(inside))
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    return dealt.withColumn(name, F.coalesce(F.sum(weight).over(before), F.lit(0)) + 1)


def positions(
    rows: DataFrame,
    group: list[str],
    buckets: dict[str, Column],
    order: list[Column],
    name: str = "rank",
    weight: str | None = None,
) -> DataFrame:
    """1-based position of every row in its group, where the data has small buckets in that order.

    ``buckets`` are leading sort expressions (ascending). Rows are numbered
    within a bucket only, and shifted by the number of rows in earlier buckets,
    with a single shuffle. Use ``numbered`` where no buckets are known. With ``weight`` a row stands for
    that many neighbouring rows and gets the position of the first of them.
    """
    keys = [*group, *buckets]
    inside = Window.partitionBy(*keys).orderBy(*order)
    if weight:
        before = inside.rowsBetween(Window.unboundedPreceding, -1)
        within = F.coalesce(F.sum(weight).over(before), F.lit(0)) + 1
        last = F.col("_within") + F.col(weight) - 1
    else:
        within = F.row_number().over(inside)
        last = F.col("_within")
    placed = rows.withColumns(buckets).withColumn("_within", within)
    # The sizes come from the numbered rows, so both sides of the join share one shuffle.
    earlier = Window.partitionBy(*group).orderBy(*buckets).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = placed.groupBy(*keys).agg(F.max(last).alias("_n")).select(
        *keys, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    position = (F.col("_before") + F.col("_within")).cast("bigint")
    return placed.join(offsets, keys).select(*rows.columns, position.alias(name))


def attach_segment_list(
    rows: DataFrame, lists: DataFrame, key: str, max_segments: int | None = None
) -> DataFrame:
    """Left join of ``rows`` to one short list per segment.

    A few segments share all rows, so a shuffle on the segment alone would use a
    few tasks. With ``max_segments`` the caller states how many segments can
    exist (bin edges, channel codes); then the lists are small by construction
    and are broadcast. Otherwise every segment is copied to 64 pieces and rows
    are dealt to the pieces, which works for any number of segments.
    """
    if max_segments is not None and max_segments <= 10_000:
        return rows.join(F.broadcast(lists), key, "left")
    pieces = 64
    rest = [c for c in rows.columns if c != key]
    dealt = rows.withColumn("_piece", F.pmod(F.xxhash64(*rest), F.lit(pieces)).cast("int"))
    copies = lists.withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1)))
    )
    return dealt.join(copies, [key, "_piece"], "left").drop("_piece")
