"""Profiling jobs: the tables behind the usual first look at a data set."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import ceil, floor, isfinite

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer, StopWordsRemover
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.text import char_count, ngrams, tokens, word_count
from basketry.llm import common
from basketry.operators.skew import join_keys
from basketry.sources.lineage import cut_lineage

QUARTILES = (0.25, 0.5, 0.75)
# Different values of a quantile bin that one task sorts; parts that a larger one is cut into.
MOST_IN_A_BIN, SUB_BINS = 1 << 20, 256
# Cells of the sketch that finds frequent n-grams.
SKETCH_CELLS = 1 << 20
# Different n-grams that a task counts before it sends them on.
HELD_NGRAMS = 1 << 18
# Bytes that separate words, as ``tokens`` does.
_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
# Types whose few possible values are numbers by themselves: their bitmaps are small.
NUMBERED_TYPES = (T.BooleanType, T.ByteType, T.ShortType, T.DateType)


def _number(column: str):
    """The column as a double; NaN counts as missing, infinite values count as numbers."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def null_counts(df: DataFrame) -> DataFrame:
    """``column, nulls`` for every column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _as_rows(counts, df.columns, "nulls")


def distinct_counts(
    df: DataFrame, columns: list[str], approximate: bool = False
) -> DataFrame:
    """``column, n_distinct``; nulls do not count.

    No row is copied once per column: every column is an aggregation of its own
    that reads nothing else. Dates and other types of few possible values are
    counted by bitmaps, which tasks merge like sums; their numbers are dense. Others
    are reduced to their different values map-side first.
    """
    if approximate:
        counts = df.agg(*[F.approx_count_distinct(F.col(c)).cast("bigint").alias(c) for c in columns])
        return _as_rows(counts, columns, "n_distinct")
    parts = [_distinct_values(df, c).agg(F.lit(c).alias("column"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_distinct")) for c in columns]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _distinct_values(df: DataFrame, column: str) -> DataFrame:
    """``n``: partial numbers of different values."""
    kind = df.schema[column].dataType
    values = df.select(F.col(column).alias("v")).where(F.col("v").isNotNull())
    if isinstance(kind, NUMBERED_TYPES):
        number = F.unix_date("v") if isinstance(kind, T.DateType) else F.col("v").cast("int")
        numbers = values.select(number.cast("bigint").alias("id"))
        bitmap = F.bitmap_construct_agg(F.bitmap_bit_position("id"))
        return numbers.groupBy(F.bitmap_bucket_number("id").alias("bucket")).agg(F.bitmap_count(bitmap).alias("n"))
    return values.distinct().select(F.lit(1).alias("n"))


def _as_rows(one_row: DataFrame, columns: list[str], name: str) -> DataFrame:
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).alias(name)) for c in columns]
    return one_row.select(F.inline(F.array(*entries)))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``value, n``, most frequent first."""
    return (
        df.groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc("value"))
    )


def histogram(df: DataFrame, column: str, width: float, low: float = 0.0) -> DataFrame:
    """Rows per fixed-width bin: ``bin_start, n``."""
    bucket = F.floor((F.col(column) - F.lit(low)) / F.lit(width))
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(bucket.alias("_bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select((F.lit(low) + F.col("_bin") * F.lit(width)).alias("bin_start"), "n")
    )


def _values(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[_number(c).alias(f"v{i}") for i, c in enumerate(columns)])


def _binned(values: DataFrame, columns: list[str], bins: int) -> DataFrame:
    """Bin of every value as ``b0, b1, ..``, cut at approximate quantiles of all columns, found in one pass."""
    names = values.columns
    fractions = [i / bins for i in range(1, bins)]
    found = values.approxQuantile(names, fractions, 1.0 / bins)
    cuts = [sorted({e for e in edges if isfinite(e)}) or [0.0] for edges in found]
    splits = [[float("-inf"), *c, float("inf")] for c in cuts]
    return Bucketizer(splitsArray=splits, inputCols=names, outputCols=[f"b{i}" for i in range(len(names))]).transform(values)


def quantile_table(
    df: DataFrame,
    columns: list[str],
    fractions: tuple[float, ...] = QUARTILES,
    bins: int = 1000,
    most: int = MOST_IN_A_BIN,
) -> DataFrame:
    """Exact, linearly interpolated quantiles of all columns together: ``column, fraction, value``.

    Approximate quantiles cut each column into bins, one pass counts the bins of
    all columns, and another keeps the different values of those that hold a
    wanted place. A kept bin of more than ``most`` different values is cut again
    by its own approximate quantiles, until all fit; only then are they sorted.
    The passes over ``df`` do not depend on the number of columns, and no task
    and no aggregation buffer holds all values. Bin sizes, ``bins`` for each
    column, come to the driver while the plan is made; a column without numbers
    has no rows.
    """
    binned = _binned(_values(df, columns), columns, bins)
    slots = range(len(columns))
    cells = F.array(*[F.struct(F.lit(i).alias("slot"), F.col(f"b{i}").alias("bin")) for i in slots])
    sizes = binned.select(F.inline(cells)).where(F.col("bin").isNotNull()).groupBy("slot", "bin").agg(F.count(F.lit(1)).alias("n")).collect()
    wanted = _places(fractions, {(r["slot"], r["bin"]): r["n"] for r in sizes})
    spark = df.sparkSession
    if not wanted:
        return spark.createDataFrame([], "column string, fraction double, value double")
    bins_of = {i: sorted({bin_ for slot, bin_, *_ in wanted if slot == i}) for i in slots}
    chosen = [
        F.when(F.col(f"b{i}").isin(bins_of[i]), F.struct(F.lit(i).alias("slot"), F.col(f"b{i}").alias("bin"), F.col(f"v{i}").alias("v")))
        for i in slots
        if bins_of[i]
    ]
    # a bin is a path of numbers: the first cut's, then those of the later ones
    values = binned.select(F.inline(F.array_compact(F.array(*chosen)))).withColumn("bin", F.col("bin").cast("int").cast("string"))
    held = cut_lineage(values.groupBy("slot", "bin", "v").agg(F.count(F.lit(1)).alias("n")))
    places = [(slot, str(int(bin_)), *rest) for slot, bin_, *rest in wanted]
    held, places = _refined(held, places, most)
    home = spark.createDataFrame(places, "slot int, bin string, before long, fraction double, place double, at long")
    inside = Window.partitionBy("slot", "bin").orderBy("v")
    hits = (
        held.withColumn("upto", F.sum("n").over(inside))
        .join(F.broadcast(home), ["slot", "bin"])  # two rows for each column and fraction
        .where((F.col("at") < F.col("before") + F.col("upto")) & (F.col("at") >= F.col("before") + F.col("upto") - F.col("n")))
    )
    low = F.max(F.when(F.col("at") == F.floor("place"), F.col("v")))
    high = F.max(F.when(F.col("at") == F.ceil("place"), F.col("v")))
    names = F.array(*[F.lit(c) for c in columns])
    return hits.groupBy("slot", "fraction", "place").agg(low.alias("low"), high.alias("high")).select(
        F.element_at(names, F.col("slot") + 1).alias("column"),
        "fraction",
        F.when(F.col("low") == F.col("high"), F.col("low"))
        .otherwise(F.col("low") + (F.col("high") - F.col("low")) * (F.col("place") - F.floor("place")))
        .alias("value"),
    )


def _places(fractions: tuple[float, ...], sizes: dict) -> list[tuple]:
    """``slot, bin, rows before the bin, fraction, place, row at it`` of both rows around every wanted place."""
    out = []
    for slot in sorted({slot for slot, _ in sizes}):
        total = sum(n for (s, _), n in sizes.items() if s == slot)
        for fraction in fractions:
            place = float(fraction) * (total - 1)
            for at in sorted({floor(place), ceil(place)}):
                before = 0
                for (s, bin_), n in sorted(sizes.items()):
                    if s == slot:
                        if at < before + n:
                            out.append((slot, bin_, before, float(fraction), place, at))
                            break
                        before += n
    return out


def _refined(held: DataFrame, places: list[tuple], most: int) -> tuple[DataFrame, list[tuple]]:
    """Cut bins of more than ``most`` different values again and keep the parts with a wanted place."""
    while True:
        rows = held.groupBy("slot", "bin").agg(F.count(F.lit(1)).alias("values")).where(F.col("values") > most)
        large = {(r["slot"], r["bin"]) for r in rows.collect()}
        if not large:
            return held, places
        fractions = [i / SUB_BINS for i in range(1, SUB_BINS)]
        edges = held.join(F.broadcast(rows.select("slot", "bin")), ["slot", "bin"]).groupBy("slot", "bin").agg(
            F.percentile_approx("v", fractions, 100 * SUB_BINS).alias("edges")
        )
        part = F.coalesce(F.size(F.filter("edges", lambda e: e < F.col("v"))).cast("string"), F.lit(""))
        cut = held.join(F.broadcast(edges), ["slot", "bin"], "left").withColumn(
            "bin", F.when(F.col("edges").isNull(), F.col("bin")).otherwise(F.concat_ws(".", "bin", F.lpad(part, 3, "0")))
        ).select("slot", "bin", "v", "n")
        cut = cut_lineage(cut)
        sizes = {(r["slot"], r["bin"]): r["n"] for r in cut.groupBy("slot", "bin").agg(F.sum("n").alias("n")).collect()}
        moved = []
        for slot, bin_, before, fraction, place, at in places:
            if (slot, bin_) in large:
                for (s, part_of), n in sorted(sizes.items()):
                    if s == slot and part_of.rpartition(".")[0] == bin_:
                        if at < before + n:
                            bin_ = part_of
                            break
                        before += n
            moved.append((slot, bin_, before, fraction, place, at))
        places = moved
        spark = held.sparkSession
        kept = spark.createDataFrame(sorted({p[:2] for p in places}), "slot int, bin string")
        held = cut_lineage(cut.join(F.broadcast(kept), ["slot", "bin"]))


def quantiles(
    df: DataFrame, column: str, fractions: tuple[float, ...] = QUARTILES, bins: int = 1000, most: int = MOST_IN_A_BIN
) -> DataFrame:
    """Exact, linearly interpolated quantiles of one column: ``fraction, value``."""
    return quantile_table(df, [column], fractions, bins, most).select("fraction", "value")


def _quartiles(df: DataFrame, columns: list[str], bins: int) -> DataFrame:
    """``column, q1, q2, q3`` of the columns that have numbers."""
    found = quantile_table(df, columns, QUARTILES, bins)
    return found.groupBy("column").agg(
        *[
            F.max(F.when(F.col("fraction") == fraction, F.col("value"))).alias(name)
            for fraction, name in zip(QUARTILES, ("q1", "q2", "q3"))
        ]
    )


def describe(df: DataFrame, columns: list[str], bins: int = 1000) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column.

    Nulls and NaN are left out; a column without numbers has count 0 and nulls.
    """
    basic = []
    for column in columns:
        c = _number(column)
        basic.append(
            F.struct(
                F.lit(column).alias("column"),
                F.count(c).alias("count"),
                F.round(F.avg(c), 6).alias("mean"),
                F.round(F.stddev_samp(c), 6).alias("std"),
                F.min(c).alias("min"),
                F.max(c).alias("max"),
            ).alias(column)
        )
    rows = df.agg(*basic).select(F.inline(F.array(*[F.col(f"`{c}`") for c in columns])))
    boxes = _quartiles(df, columns, bins)
    return rows.join(F.broadcast(boxes), "column", "left").select(  # a row for each column
        "column", "count", "mean", "std", "min", *[F.round(q, 6).alias(q) for q in ("q1", "q2", "q3")], "max"
    )


def box_table(df: DataFrame, columns: list[str], bins: int = 1000) -> DataFrame:
    """Per column the quartiles, whiskers (last value within 1.5 interquartile ranges) and outliers."""
    boxes = {r["column"]: r for r in _quartiles(df, columns, bins).collect()}
    parts = []
    for column in columns:
        c = _number(column)
        quartile = [boxes[column][q] if column in boxes else None for q in ("q1", "q2", "q3")]
        q1, _, q3 = quartile
        within = c.between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)) if column in boxes else F.lit(False)
        parts.append(
            F.struct(
                F.lit(column).alias("column"),
                *[F.round(F.lit(v).cast("double"), 6).alias(q) for q, v in zip(("q1", "q2", "q3"), quartile)],
                F.min(F.when(within, c)).alias("whisker_low"),
                F.max(F.when(within, c)).alias("whisker_high"),
                F.count_if(c.isNotNull() & ~within).alias("outliers"),
            ).alias(column)
        )
    return df.agg(*parts).select(F.inline(F.array(*[F.col(f"`{c}`") for c in columns])))


def box_stats(df: DataFrame, column: str, bins: int = 1000) -> DataFrame:
    """``box_table`` of one column, without its name."""
    return box_table(df, [column], bins).drop("column")


def key_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Different keys on the left only, on both sides and on the right only."""
    sides = left.select(
        F.col(key).alias("key"), F.lit(1).alias("on_left"), F.lit(0).alias("on_right")
    ).unionByName(
        right.select(
            F.col(key).alias("key"), F.lit(0).alias("on_left"), F.lit(1).alias("on_right")
        )
    )
    seen = (
        sides.where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.max("on_left").alias("on_left"), F.max("on_right").alias("on_right"))
    )
    return seen.agg(
        F.count_if((F.col("on_left") == 1) & (F.col("on_right") == 0)).alias("left_only"),
        F.count_if((F.col("on_left") == 1) & (F.col("on_right") == 1)).alias("both"),
        F.count_if((F.col("on_left") == 0) & (F.col("on_right") == 1)).alias("right_only"),
    )


def unmatched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Different keys of ``left`` that ``right`` does not have."""
    return join_keys(left.select(key).distinct(), right, [key], "left_anti")


def english_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def _ngrams_of(df: DataFrame, text: str, n: int, stop_words: list[str] | None) -> DataFrame:
    """All n-grams of whole texts, one row each."""
    return _words(df, text, stop_words).select(F.explode(ngrams(F.col("words"), n)).alias("ngram"))


def _words(df: DataFrame, text: str, stop_words: list[str] | None) -> DataFrame:
    words = df.select(tokens(text, lower=True).alias("words")).where(F.col("words").isNotNull())
    if stop_words:
        words = (
            StopWordsRemover(inputCol="words", outputCol="kept", stopWords=stop_words)
            .transform(words)
            .select(F.col("kept").alias("words"))
        )
    return words


def ngram_counts(
    df: DataFrame, text: str, n: int = 1, stop_words: list[str] | None = None
) -> DataFrame:
    """``ngram, n`` over whole texts in lower case; stop words leave before n-grams form."""
    return _ngrams_of(df, text, n, stop_words).groupBy("ngram").agg(F.count(F.lit(1)).alias("n"))


def top_ngrams(
    df: DataFrame, text: str, n: int = 1, k: int = 20, stop_words: list[str] | None = None, cells: int = SKETCH_CELLS
) -> DataFrame:
    """The ``k`` most frequent n-grams, ties in alphabetical order; exact, without shuffling all n-grams.

    A first pass counts hash cells, ``cells`` numbers in all, as one row of a count-min
    sketch: no n-gram occurs more often than its cell. Of the fullest cells the
    n-grams are counted; the ``k``-th of these is a bound, and cells below it hold none of
    the ``k``. If other cells reach it, a last pass counts all that do. Sketch and
    counts are written to the checkpoint folder while the plan is made. Both passes hash
    n-grams in Arrow tasks, on the bytes of many texts at once.
    """
    texts = _texts(df, text, stop_words)
    sketch = cut_lineage(texts.mapInArrow(_cell_counter(n, cells), "cell bigint, full bigint").groupBy("cell").agg(F.sum("full").alias("full")))
    fullest = sketch.orderBy(F.desc("full"), "cell").limit(2 * k).collect()
    counts = cut_lineage(_counted_cells(texts, n, cells, [r["cell"] for r in fullest]))
    kth = counts.orderBy(F.desc("n")).limit(k).agg(F.min("n"), F.count(F.lit(1))).first()
    bound = kth[0] if kth[1] == k else 1
    if len(fullest) == 2 * k and fullest[-1]["full"] >= bound:  # else all that reach the bound are counted
        reached = sketch.where(F.col("full") >= bound).select("cell").toArrow()  # numbers of ``cells`` cells at most
        counts = _counted_cells(texts, n, cells, reached.column("cell").to_pylist())
    return counts.orderBy(F.desc("n"), F.asc("ngram")).limit(k)


def _texts(df: DataFrame, text: str, stop_words: list[str] | None) -> DataFrame:
    """Texts in lower case, without stop words."""
    if not stop_words:
        return df.select(F.lower(F.col(text)).alias("text")).where("text IS NOT NULL")
    return _words(df, text, stop_words).select(F.array_join("words", " ").alias("text"))


def _hashed_ngrams(batches: Iterator[pa.RecordBatch], n: int, cells: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Of some texts at a time the bytes, start and end of every word, the first word of every n-gram and its cell."""
    for batch in batches:
        column = common.string_column(batch.column(0))
        for start, stop in common.chunks(column):
            texts = common.Texts(column.slice(start, stop - start))
            starts, ends, first = common.word_spans(texts.bytes, texts.offsets, _SPACE)
            words = common.word_hashes(texts.bytes, starts, ends)
            size = len(words) - n + 1
            if size < 1:
                continue
            owner = np.repeat(np.arange(len(texts)), np.diff(first))
            at = np.flatnonzero(owner[:size] == owner[n - 1 :])
            value = np.zeros(len(at), dtype=np.uint64)
            for k in range(n):
                value = common.mix(value + words[at + k])
            yield texts.bytes, starts, ends, at, (value % np.uint64(cells)).astype(np.int64)


def _cell_counter(n: int, cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = np.zeros(cells, dtype=np.int64)
        for *_, cell in _hashed_ngrams(batches, n, cells):
            np.add.at(full, cell, 1)
        there = np.flatnonzero(full)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(full[there])], names=["cell", "full"])

    return run


def _counted_cells(texts: DataFrame, n: int, cells: int, wanted: list[int]) -> DataFrame:
    """``ngram, n`` of the n-grams of some cells. A task counts up to ``HELD_NGRAMS`` different ones at a time."""
    mask = np.zeros(cells, dtype=bool)
    mask[wanted] = True
    shared = texts.sparkSession.sparkContext.broadcast(np.packbits(mask))  # a bit for each cell

    def batch_of(counts: Counter) -> pa.RecordBatch:
        grams = pa.array(list(counts), pa.binary()).cast(pa.string(), safe=False)
        return pa.RecordBatch.from_arrays([grams, pa.array(list(counts.values()), pa.int64())], names=["ngram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, counts = np.unpackbits(shared.value, count=cells).view(bool), Counter()
        for data, starts, ends, at, cell in _hashed_ngrams(batches, n, cells):
            raw, found = data.tobytes(), at[chosen[cell]]
            spans = zip(*[starts[found + k].tolist() for k in range(n)], *[ends[found + k].tolist() for k in range(n)])
            counts.update(b" ".join([raw[s[k] : s[n + k]] for k in range(n)]) for s in spans)
            if len(counts) > HELD_NGRAMS:
                yield batch_of(counts)
                counts = Counter()
        yield batch_of(counts)

    return texts.mapInArrow(run, "ngram string, n bigint").groupBy("ngram").agg(F.sum("n").alias("n"))


def word_frequencies(
    df: DataFrame, text: str, stop_words: list[str] | None = None
) -> DataFrame:
    return ngram_counts(df, text, 1, stop_words)


def text_lengths(df: DataFrame, text: str) -> DataFrame:
    """The table with ``string_count`` and ``word_count``; rows without text are left out."""
    return df.where(F.col(text).isNotNull()).withColumns(
        {"string_count": char_count(text), "word_count": word_count(text)}
    )


def table_overview(df: DataFrame, rows: int = 5) -> dict:
    """Schema, row count, column count and the first few rows."""
    return {
        "schema": df.schema.simpleString(),
        "rows": df.count(),
        "columns": len(df.columns),
        "head": df.limit(rows),
    }


def channel_article_counts(tx: DataFrame) -> DataFrame:
    """Rows per (channel, article), to compare what sells in each channel."""
    return tx.groupBy("sales_channel_id", "article_id").agg(F.count(F.lit(1)).alias("n"))
