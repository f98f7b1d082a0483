"""Ranked lexical search by dense blocked matrix products.

The terms of a block of items are its vocabulary. Documents are taken in tiles: the
impacts of the vocabulary's terms that occur in a tile are a dense matrix, the
weights of these terms in the items another, and their product are all scores. The
vocabulary is cut into tiles too, so that no sum of a product reaches 2^53: all
numbers are whole and float64 holds them exactly; sums over tiles are 64-bit
integers. Of a tile every item keeps its k best scores and all ties of the last,
which are merged with those of the tiles before.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm import common

#: Documents in a tile; terms in a vocabulary tile.
DOCUMENTS, TERMS = 512, 2048
#: Items, and bytes of their texts, that one pass over the documents ranks for; more take more passes.
ITEMS, ITEM_BYTES = 2048, 4 << 20
#: An impact is a share of this that is never reached; a product's sums stay below the second number.
IMPACT, EXACT = 1_000_000, 1 << 53

_APART = np.ones(256, dtype=bool)
_APART[0x30:0x3A] = _APART[0x61:0x7B] = _APART[0x41:0x5B] = _APART[0x80:] = False


def terms(texts: common.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms and the number of terms before each text."""
    data = common.LOWER[texts.bytes]
    starts, ends, index = common.word_spans(data, texts.offsets, _APART)
    return common.word_hashes(data, starts, ends), index


def frequencies(texts: common.Texts, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of terms of each text; of the (text, vocabulary term) pairs that occur: text, term, occurrences."""
    words, index = terms(texts)
    sizes = np.diff(index)
    if not len(vocabulary):
        none = np.zeros(0, np.int64)
        return sizes, none, none, none
    at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
    known = vocabulary[at] == words
    pair = np.repeat(np.arange(len(sizes)), sizes)[known] * len(vocabulary) + at[known]
    pair, count = np.unique(pair, return_counts=True)
    return sizes, pair // len(vocabulary), pair % len(vocabulary), count


def impact(occurrences: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Share of ``IMPACT`` by occurrences and length factor (75 or more), rounded down."""
    return 1000 * IMPACT * occurrences // (1000 * occurrences + 12 * length)


def length_factor(sizes: np.ndarray, documents: int, total: int) -> np.ndarray:
    """100 - 25 + 25 * size / mean size, rounded down, in whole numbers."""
    exact = sizes.astype(object) if len(sizes) and 25 * int(sizes.max()) * documents >= 1 << 63 else sizes
    return (75 + (25 * exact * documents) // max(1, total)).astype(np.int64)


class Items:
    """Vocabulary and term counts of a block of items; weights once the corpus is known."""

    def __init__(self, rows: list[tuple[str, str]]) -> None:
        self.names = [name for name, _ in rows]
        words, index = terms(common.Texts(pa.array([text for _, text in rows], pa.string())))
        item = np.repeat(np.arange(len(rows)), np.diff(index))
        self.vocabulary, place = np.unique(words, return_inverse=True)
        pair, count = np.unique(place * max(1, len(rows)) + item, return_counts=True)  # by term, then item
        self.term, self.item, self.count = pair // max(1, len(rows)), pair % max(1, len(rows)), count
        self.tiles: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def weigh(self, documents: int, holding: np.ndarray, columns: int = TERMS, exact: int = EXACT) -> None:
        """Cut weights into tiles of (terms, first entry of each, items, weights).

        The largest weights of a tile's terms times ``IMPACT`` stay below ``exact`` together.
        A term that is too heavy for that is in several tiles with parts of its weight.
        """
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) for n in holding], dtype=np.int64)
        values = weight[self.term] * self.count
        limit = (exact - 1) // IMPACT
        edge = np.searchsorted(self.term, np.arange(len(self.vocabulary) + 1))
        heavy = np.maximum.reduceat(values, edge[:-1]) if len(values) else values
        self.tiles, open_, used = [], [], 0

        def close() -> None:
            nonlocal used
            if open_:
                parts = [np.minimum(np.maximum(values[edge[t] : edge[t + 1]] - skip, 0), limit) for t, skip in open_]
                first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
                chosen = np.array([t for t, _ in open_], dtype=np.int64)
                self.tiles.append((chosen, first, np.concatenate([self.item[edge[t] : edge[t + 1]] for t, _ in open_]), np.concatenate(parts)))
            open_.clear()
            used = 0

        for t, most in enumerate(heavy.tolist()):
            for skip in range(0, most, limit):
                part = min(most - skip, limit)
                if used + part > limit or len(open_) == columns:
                    close()
                open_.append((t, skip))
                used += part
        close()

    def scores(self, text: np.ndarray, term: np.ndarray, impacts: np.ndarray, texts: int) -> np.ndarray:
        """Scores of all items (rows) for a tile of documents (columns), of whose terms the impacts are given."""
        total = np.zeros((len(self.names), texts), dtype=np.int64)
        place = np.full(len(self.vocabulary), -1, dtype=np.int64)
        for chosen, first, item, weight in self.tiles:
            present = np.flatnonzero(np.isin(chosen, term))  # only terms that occur in the tile
            if not len(present):
                continue
            place[:] = -1
            place[chosen[present]] = np.arange(len(present))
            here = place[term]
            documents = np.zeros((len(present), texts))
            documents[here[here >= 0], text[here >= 0]] = impacts[here >= 0]
            size = first[present + 1] - first[present]
            entry = np.repeat(first[present] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            items = np.zeros((len(self.names), len(present)))
            items[item[entry], np.repeat(np.arange(len(present)), size)] = weight[entry]
            total += (items @ documents).astype(np.int64)
        return total


class Best:
    """Each item's ``k`` best documents so far: by score, then id; a null id comes last."""

    def __init__(self, items: int, k: int) -> None:
        self.items, self.k = items, k
        self.rows = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)]  # item, score, id is null, id

    def add(self, scores: np.ndarray, none: np.ndarray, ids: np.ndarray) -> None:
        item, score = self.rows[:2]
        held = np.bincount(item, minlength=self.items)
        floor = np.ones(self.items, dtype=np.int64)
        last = np.cumsum(held)[held == self.k] - 1
        floor[held == self.k] = score[last]
        if scores.shape[1] > self.k:
            bound = np.partition(scores, scores.shape[1] - self.k, axis=1)[:, -self.k]
            floor = np.maximum(floor, bound)
        row, column = np.nonzero(scores >= floor[:, None])
        if not len(row):
            return
        new = [row, scores[row, column], none[column], ids[column]]
        item, score, absent, number = (np.concatenate(pair) for pair in zip(self.rows, new, strict=True))
        order = np.lexsort((number, absent, -score, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        kept = order[rank < self.k]
        self.rows = [item[rank < self.k], score[kept], absent[kept], number[kept]]


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[Items]:
    """Blocks of items; one row for each id, the one of the smallest text."""
    rows = items.select(F.col(f"`{item_id}`").cast("string").alias("i"), F.col(f"`{text}`").alias("t")).where("i is not null and t is not null")
    block, used = [], 0
    for row in rows.groupBy("i").agg(F.min("t").alias("t")).toLocalIterator():
        size = len(row["t"].encode())
        if block and (used + size > ITEM_BYTES or len(block) == ITEMS):
            yield Items(block)
            block, used = [], 0
        block.append((row["i"], row["t"]))
        used += size
    if block:
        yield Items(block)


def _corpus(docs: DataFrame, text: str, vocabulary: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Documents with terms, terms of all, and documents that hold each term of the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # of ITEM_BYTES at most, or one item

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        documents = total = 0
        holding = np.zeros(len(known), dtype=np.int64)
        for batch in batches:
            column = common.string_column(batch.column(0))
            for start, stop in common.chunks(column):
                sizes, _, term, _ = frequencies(common.Texts(column.slice(start, stop - start)), known)
                documents += int((sizes > 0).sum())
                total += int(sizes.sum())
                holding += np.bincount(term, minlength=len(known))
        some = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-2, -1], some])), pa.array(np.concatenate([[documents, total], holding[some]]))], names=["term", "n"])
        common.release()

    counted = docs.select(F.col(f"`{text}`").cast("string")).mapInArrow(count, "term long, n long")
    rows = dict(counted.groupBy("term").agg(F.sum("n")).collect())  # one for each term of the vocabulary at most
    return rows.get(-2, 0), rows.get(-1, 0), np.array([rows.get(t, 0) for t in range(len(vocabulary))], dtype=np.int64)


def rank(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    id_column: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score``: the ``k`` best documents of each item, with scores above 0.

    Document ids are whole numbers; equal scores go by ascending id, null ids last.
    Repeated document rows count each. Null texts have no terms. Items with a null
    id or text take no part, and of a repeated item id the smallest text counts.
    Other columns are not looked at. Terms are known by 64-bit hashes.
    """
    spark = docs.sparkSession
    kind = items.schema[item_id].dataType
    source = docs.select(F.col(f"`{id_column}`").cast("long"), F.col(f"`{text}`").cast("string"))
    found = None
    for block in _blocks(items, item_id, item_text):
        documents, total, holding = _corpus(docs, text, block.vocabulary)
        block.weigh(documents, holding)
        shared = spark.sparkContext.broadcast(block)  # ITEM_BYTES of text at most, or one item

        def score(batches: Iterator[pa.RecordBatch], shared=shared, documents=documents, total=total) -> Iterator[pa.RecordBatch]:
            known = shared.value
            best = Best(len(known.names), k)
            for batch in batches:
                ids, texts = batch.column(0), common.string_column(batch.column(1))
                for a, b in common.chunks(texts):
                    for start in range(a, b, DOCUMENTS):
                        size = min(b - start, DOCUMENTS)
                        sizes, doc, term, count = frequencies(common.Texts(texts.slice(start, size)), known.vocabulary)
                        values = impact(count, length_factor(sizes, documents, total)[doc])
                        part = ids.slice(start, size)
                        best.add(known.scores(doc, term, values, size), np.asarray(part.is_null()), np.asarray(part.fill_null(0)))
            item, points, none, number = best.rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([known.names[i] for i in item], pa.string()), pa.array(number, mask=none), pa.array(points)], names=["item_id", "doc_id", "score"]
            )
            common.release()

        part = source.mapInArrow(score, "item_id string, doc_id long, score long")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "item_id string, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item_id").cast(kind).alias("item_id"), "rank", "doc_id", "score")
