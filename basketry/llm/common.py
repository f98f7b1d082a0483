"""Helpers that the text operators share.

Python code runs inside ``mapInArrow`` tasks on whole Arrow batches. Texts are
seen as one flat UTF-8 buffer with offsets, so numpy works on all bytes of many
documents at once; a chunk limits how much of it is in memory together.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Bytes of text that one numpy step works on; a longer text is one step of its own.
CHUNK_BYTES = 1 << 19

#: Function from the texts of a chunk to the values of the new columns.
TextFunction = Callable[["Texts"], list]


class Texts:
    """Consecutive texts as one byte buffer; a null text is an empty one."""

    def __init__(self, column: pa.Array) -> None:
        column = pc.fill_null(column, "")
        wide = pa.types.is_large_string(column.type)
        _, offsets, data = column.buffers()
        kind = np.int64 if wide else np.int32
        first = column.offset
        ends = np.frombuffer(offsets, dtype=kind)[first : first + len(column) + 1] if len(column) else np.zeros(1, kind)
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.column = column
        self.bytes = raw[int(ends[0]) : int(ends[-1])]
        self.offsets = ends.astype(np.int64) - int(ends[0])

    def __len__(self) -> int:
        return len(self.column)

    def strings(self) -> list[str]:
        return self.column.to_pylist()

    def encoded(self) -> list[bytes]:
        data = self.bytes.tobytes()
        return [data[a:b] for a, b in zip(self.offsets[:-1], self.offsets[1:], strict=True)]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column whose bytes stay under ``limit``, one row at least."""
    yield from steps(np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64), limit)


def steps(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes sum up to ``limit`` at most, one row at least."""
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield start, stop
        start = stop


def string_column(column: pa.Array) -> pa.Array:
    return column if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else column.cast(pa.string())


def with_text_columns(
    df: DataFrame,
    text: str,
    fields: list[tuple[str, T.DataType]],
    make: Callable[[], TextFunction],
    keep: list[str] | None = None,
    limit: int = CHUNK_BYTES,
) -> DataFrame:
    """Columns ``keep`` (default: all) of ``df`` and new columns made from its texts.

    ``make`` is called once in each task and returns the function that turns the
    ``Texts`` of a chunk into one sequence per field. A kept column that has the
    name of a new one is replaced by it. Rows keep their order and number.
    """
    new = {name.lower() for name, _ in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    columns = [F.col(f"`{c}`") for c in kept]
    where = kept.index(text) if text in kept else len(kept)
    if where == len(kept):
        columns.append(F.col(f"`{text}`").cast("string").alias("__text"))
    source = df.select(*columns)
    schema = T.StructType(
        [source.schema[i] for i in range(len(kept))] + [T.StructField(n, t) for n, t in fields]
    )
    types = [to_arrow_type(t) for _, t in fields]
    names = [*kept, *(n for n, _ in fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            texts = string_column(batch.column(where))
            for start, stop in chunks(texts, limit):
                values = function(Texts(texts.slice(start, stop - start)))
                arrays = [v if isinstance(v, pa.Array) else pa.array(v, type=t) for v, t in zip(values, types, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(start, stop - start) for i in range(len(kept))] + arrays, names=names
                )
        release()

    return source.mapInArrow(run, schema)


def release() -> None:
    """Give memory that a finished task no longer uses back to the system; the worker lives on for later tasks."""
    gc.collect()
    trim()


def trim() -> None:
    """Give free memory back to the system, without a look for unreachable objects."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # the C library of Linux has it, others may not
        trim(0)


def set_aside(df: DataFrame, names: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns of these names renamed, and the renaming."""
    clash = {c: f"__own_{c}" for c in df.columns if c.lower() in {n.lower() for n in names}}
    return df.withColumnsRenamed(clash), clash


def restored(df: DataFrame, like: DataFrame, renamed: dict[str, str]) -> DataFrame:
    """The columns of ``like`` from ``df``, under their own names."""
    return df.select(*[F.col(f"`{renamed.get(c, c)}`").alias(c) for c in like.columns])


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every bit depends on all others."""
    y = x >> np.uint64(31)
    y ^= x
    y *= np.uint64(0x9E3779B97F4A7C15)
    y ^= y >> np.uint64(29)
    y *= np.uint64(0xD6E8FEB86659FD93)
    y ^= y >> np.uint64(32)
    return y


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x5851F42D4C957F2D


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word and the number of words before each text.

    ``separator`` says for each byte value whether it separates words. Words end
    at the end of their text.
    """
    apart = separator[data]
    n = len(data)
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True  # a text begins (or all end) here
    before = np.ones(n, dtype=bool)
    before[1:] = apart[:-1]
    starts = np.flatnonzero(~apart & (before | edge[:n]))
    after = np.ones(n, dtype=bool)
    after[:-1] = apart[1:]
    ends = np.flatnonzero(~apart & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lengths = ends - starts
    place = np.arange(len(data), dtype=np.int64)
    owner = np.zeros(len(data), dtype=np.int64)
    owner[starts] = starts
    np.maximum.accumulate(owner, out=owner)
    place -= owner
    # bytes between words count for the word before them: cut them off by length
    value = _BYTE_VALUES[data] * powers(_BASE, int(place.max()) + 1)[place]
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(value, out=total[1:])
    return mix(total[ends] - total[starts] + lengths.astype(np.uint64))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
