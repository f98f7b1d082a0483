"""Exact top-k search by inner product, term at a time.

Candidates are cut into chunks; each chunk is an inverted index from dimension to
the candidates with a value there. A query's terms scatter their weighted
postings into a dense array of scores, of which a partition step selects the
best; the best of all chunks are merged. Nothing is skipped, so results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors in a chunk of candidates and in a block of queries.
CHUNK = 4096
BLOCK = 1024


def whole_numbers(vector, scale: int = 256):
    """Column: floor(scale * x) of every component; null for a vector with null or non-finite ones."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    good = vector.isNotNull() & ~F.exists(vector, odd)
    return F.when(good, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows, filled up with 0 to the longest."""
    values, offsets = np.asarray(column.values), np.asarray(column.offsets)
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), dtype="<i8")
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(int(sizes.sum())) - np.repeat(offsets[:-1] - offsets[0], sizes)] = values[offsets[0] : offsets[-1]]
    return out


def _packed(vectors: DataFrame) -> DataFrame:
    """Rows (id, v) as chunks of at most ``CHUNK`` rows: ids and values, each as one binary value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                part = batch.slice(start, CHUNK)
                ids = np.asarray(part.column(0)).astype("<i8")
                values = _matrix(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids.tobytes()], pa.binary()), pa.array([values.tobytes()], pa.binary()), pa.array([len(ids)], pa.int32())],
                    names=["ids", "values", "n"],
                )

    return vectors.mapInArrow(run, "ids binary, values binary, n int")


def postings(values: np.ndarray) -> list[tuple[np.ndarray | slice, np.ndarray]]:
    """Of each dimension the candidates with a value there and the values."""
    out = []
    for column in np.ascontiguousarray(values.T):
        at = np.flatnonzero(column)
        out.append((slice(None), column) if len(at) == len(column) else (at, column[at]))
    return out


def best(query: np.ndarray, own: int, index, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the ``k`` best candidates of a chunk and all that tie with the last, but for the query's own."""
    scores = np.zeros(len(ids), dtype=np.int64)
    for term in np.flatnonzero(query[: len(index)]):
        at, weights = index[term]
        scores[at] += query[term] * weights
    other = ids != own
    scores, ids = scores[other], ids[other]
    if len(ids) > k:
        bound = np.partition(scores, len(scores) - k)[len(scores) - k]
        chosen = scores >= bound
        scores, ids = scores[chosen], ids[chosen]
        order = np.lexsort((ids, -scores))[:k]
        scores, ids = scores[order], ids[order]
    return ids, scores


def search(queries: DataFrame, candidates: DataFrame, k: int = 5, id_column: str = "vec_id", vector: str = "v") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: each query's ``k`` best candidates.

    Vectors are arrays of longs, a missing component counts as 0. Ties go to the
    smaller id. Candidates with the query's id are left out. Rows with a null id
    or vector take no part. A repeated query id is asked once, with its smallest
    vector; repeated candidate rows count each. Blocks of queries meet chunks of
    candidates in a join on (block, piece), so that the work is spread whatever
    their numbers.
    """
    spark = queries.sparkSession
    usable = lambda df: df.select(F.col(id_column).cast("long").alias("id"), F.col(vector).alias("v")).where("id is not null and v is not null")
    asked = usable(queries).groupBy("id").agg(F.min("v").alias("v"))
    number = asked.count()
    blocks = max(1, -(-number // BLOCK))
    pieces = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) * 2 // blocks))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    lists = asked.groupBy(block.alias("block")).agg(F.collect_list(F.struct("id", "v")).alias("q"))  # about BLOCK rows each
    asked_in = lists.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
    chunks = _packed(usable(candidates))
    chunks = chunks.withColumn("piece", F.pmod(F.xxhash64("ids"), F.lit(pieces)).cast("int"))
    chunks = chunks.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    met = chunks.join(asked_in, ["block", "piece"]).select("ids", "values", "n", "q.id", "q.v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = np.frombuffer(batch.column(0)[row].as_buffer(), dtype="<i8")
                index = postings(np.frombuffer(batch.column(1)[row].as_buffer(), dtype="<i8").reshape(len(ids), -1))
                own, vectors = np.asarray(batch.column(3)[row].values), _matrix(batch.column(4)[row].values)
                found = [best(q, o, index, ids, k) for q, o in zip(vectors, own, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(own, [len(i) for i, _ in found])),
                        pa.array(np.concatenate([i for i, _ in found])),
                        pa.array(np.concatenate([s for _, s in found])),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    partial = met.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
