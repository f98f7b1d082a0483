"""Exact search by inner product over factor tables.

Items are taken in blocks by falling norm. No item of a block can score more than the
user's norm times the block's largest, so a user whose ``k``-th best score is over
that needs neither the block nor any later one. Users are never joined with items:
a part of the items, of a bounded size, is sent to all tasks at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.skew import numbered
from basketry.sources.lineage import cut_lineage

# Items in a block, users in a step, and bytes of item factors that are sent to all tasks at a time.
BLOCK, USERS, PART_BYTES = 512, 1024, 32 << 20


class Items:
    """Some items by falling norm; ids break ties, so they are smaller integers than 2^53."""

    def __init__(self, ids: np.ndarray, factors: np.ndarray) -> None:
        norms = np.sqrt((factors * factors).sum(axis=1))
        order = np.lexsort((ids, -norms))
        self.ids, self.factors, self.norms = ids[order], factors[order], norms[order]

    def best(self, users: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> int:
        """Improve the best items of each user, rows of ``ids`` and falling ``scores``; number of (user, block) products."""
        k = scores.shape[1]
        norms = np.sqrt((users * users).sum(axis=1)) * (1 + 1e-12)  # rounding must not hide an item
        products = 0
        for start in range(0, len(self.ids), BLOCK):
            open_ = np.flatnonzero(scores[:, -1] <= norms * self.norms[start])
            if not len(open_):
                break
            products += len(open_)
            found = users[open_] @ self.factors[start : start + BLOCK].T
            better = found.max(axis=1) >= scores[open_, -1]
            open_, found = open_[better], found[better]
            both = np.concatenate([scores[open_], found], axis=1)
            names = np.concatenate([ids[open_], np.broadcast_to(self.ids[start : start + BLOCK], found.shape)], axis=1)
            order = np.lexsort((names, -both), axis=1)[:, :k]
            scores[open_] = np.take_along_axis(both, order, axis=1)
            ids[open_] = np.take_along_axis(names, order, axis=1)
        return products


def _matrix(column: pa.Array) -> np.ndarray:
    return np.stack(column.to_numpy(zero_copy_only=False)).astype(np.float64) if len(column) else np.zeros((0, 0))


def best_items(users: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """``id, rank, item, score``: the ``k`` items of largest inner product for each row of ``users``, all if they are fewer.

    Both tables have ``id`` (a whole number) and ``features`` (an array of equal
    length). Ties go to the smaller item id. Several parts of items take several
    passes over the users, each of which is written before the next.
    """
    first = items.select(F.size("features").alias("n")).first()
    if first is None:
        return users.sparkSession.createDataFrame([], "id long, rank int, item long, score double")
    size = max(1, PART_BYTES // (8 * max(1, first["n"])))
    norm = F.aggregate("features", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    one = items.select(F.lit(1).alias("all"), F.col("id").cast("bigint"), "features", norm.alias("norm"))
    placed = cut_lineage(numbered(one, ["all"], [F.desc("norm"), F.asc("id")], "place"))
    state = users.select(
        F.col("id").cast("bigint"), "features", F.array().cast("array<bigint>").alias("items"), F.array().cast("array<double>").alias("scores")
    )
    parts = -(-placed.count() // size)
    for part in range(parts):
        here = placed.where((F.col("place") > part * size) & (F.col("place") <= (part + 1) * size)).select("id", "features").toArrow()
        factors = _matrix(here["features"].combine_chunks())
        shared = users.sparkSession.sparkContext.broadcast(Items(here["id"].to_numpy(), factors))  # PART_BYTES at most

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for whole in batches:
                for start in range(0, whole.num_rows, USERS):
                    batch = whole.slice(start, USERS)
                    ids = np.full((batch.num_rows, k), np.iinfo(np.int64).max)
                    scores = np.full((batch.num_rows, k), -np.inf)
                    for row, (i, s) in enumerate(zip(batch["items"].to_pylist(), batch["scores"].to_pylist(), strict=True)):
                        ids[row, : len(i)], scores[row, : len(s)] = i, s
                    known.best(_matrix(batch["features"]), ids, scores)
                    real = np.isfinite(scores)
                    lists = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(real.sum(axis=1))]), pa.int32()), pa.array(x[real])) for x in (ids, scores)]
                    yield pa.RecordBatch.from_arrays([batch["id"], batch["features"], *lists], names=["id", "features", "items", "scores"])

        state = state.mapInArrow(run, state.schema)
        if part + 1 < parts:
            state = cut_lineage(state)
    ranked = state.select("id", F.posexplode(F.arrays_zip("items", "scores")).alias("place", "best"))
    return ranked.select("id", (F.col("place") + 1).alias("rank"), F.col("best.items").alias("item"), F.col("best.scores").alias("score"))
