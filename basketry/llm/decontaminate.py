"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts are normalised to words joined by one blank, and every window of ten
benchmark words is a pattern with a blank on both sides. Many cursors move over
a chunk at once: each looks at the block that ends its window, jumps by the
block's entry in the shift table, and stops where the shift is 0. There the
bucket of the block names the patterns whose first ``m`` bytes end so; their
first bytes are compared, and then the whole pattern, directly.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm import common
from basketry.llm.storage import cut

#: Consecutive words of a benchmark item that count as contamination.
WINDOW = 10
#: Bytes of benchmark text whose tables one pass over the documents holds; more items take more passes.
BLOCK_BYTES = 16 << 20
#: Cursors that move together over a chunk.
LANES = 2048
#: Patterns shorter than this have tables of their own, with shorter blocks.
SHORT = 24
_TABLE_BITS = 20

#: Word characters: digits, letters and all that is not ASCII; A-Z become a-z, the rest a blank.
_NORMAL = np.full(256, 0x20, dtype=np.uint8)
_NORMAL[0x30:0x3A] = np.arange(0x30, 0x3A)
_NORMAL[0x61:0x7B] = np.arange(0x61, 0x7B)
_NORMAL[0x41:0x5B] = np.arange(0x61, 0x7B)
_NORMAL[0x80:] = np.arange(0x80, 0x100)
#: Stands between texts; never part of UTF-8.
_EDGE = 0xFF


def normalise(texts: list[bytes]) -> np.ndarray:
    """Each text as `` w1 w2 .. wn `` followed by the edge byte."""
    joined = b" " + b" \xff ".join(texts) + b" \xff "
    plain = _NORMAL[np.frombuffer(joined, dtype=np.uint8)]
    blank = plain == 0x20
    again = np.zeros(len(plain), dtype=bool)
    again[1:] = blank[1:] & blank[:-1]
    return plain[~again]


def words_of(text: bytes) -> list[bytes]:
    return normalise([text])[:-2].tobytes().split()


def windows(text: bytes, size: int = WINDOW) -> list[bytes]:
    """The windows of an item; all its words if they are fewer, none without words."""
    words = words_of(text)
    last = max(1, len(words) - size + 1) if words else 0
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(last)]


class Matcher:
    """Shift table and suffix buckets of one set of patterns."""

    def __init__(self, patterns: list[bytes], block: int) -> None:
        self.patterns = patterns
        self.block = block
        self.mask = np.uint64((1 << (8 * block)) - 1)
        self.m = m = min(map(len, patterns))
        heads = np.frombuffer(b"".join(p[:m] for p in patterns), dtype=np.uint8).reshape(-1, m)
        self.shift = np.full(1 << _TABLE_BITS, m - block + 1, dtype=np.int32)
        for end in range(block, m + 1):
            np.minimum.at(self.shift, self._slot(self._value(heads[:, end - block : end])), m - end)
        suffix = self._value(heads[:, m - block :])
        order = np.argsort(suffix, kind="stable")
        self.suffix, self.order = suffix[order], order
        self.first = self._value(heads[:, :block])[order]

    def _value(self, columns: np.ndarray) -> np.ndarray:
        out = np.zeros(len(columns), dtype=np.uint64)
        for i in range(columns.shape[1]):
            out |= columns[:, i].astype(np.uint64) << np.uint64(8 * i)
        return out

    def _slot(self, value: np.ndarray) -> np.ndarray:
        return (value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _TABLE_BITS)

    def search(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and pattern number of every occurrence in a normalised text."""
        n, m, block = len(text), self.m, self.block
        if n < m:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        padded = np.concatenate([text, np.zeros(8, np.uint8)])
        eight = np.ndarray(shape=(n,), dtype="<u8", buffer=padded, strides=(1,))
        step = max(256, -(-n // LANES))
        at = np.arange(0, n - m + 1, step, dtype=np.int64)  # where the window of each cursor begins
        stop = np.minimum(at + step, n - m + 1)
        stops = []
        while len(at):
            shift = self.shift[self._slot(eight[at + (m - block)] & self.mask)]
            hit = shift == 0
            if hit.any():
                stops.append(at[hit])
            at = at + np.maximum(shift, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        if not stops:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        where = np.concatenate(stops)
        ending = eight[where + (m - block)] & self.mask
        low = np.searchsorted(self.suffix, ending, side="left")
        size = np.searchsorted(self.suffix, ending, side="right") - low
        starts = np.repeat(where, size)
        entry = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        same = (eight[starts] & self.mask) == self.first[entry]
        starts, numbers = starts[same], self.order[entry[same]]
        raw = text.tobytes()
        real = [raw.startswith(self.patterns[k], s) for s, k in zip(starts.tolist(), numbers.tolist(), strict=True)]
        return starts[real], numbers[real]


class Benchmark:
    """The windows of some items and the tables to find them."""

    def __init__(self, items: list[tuple[str, bytes]], size: int = WINDOW) -> None:
        owners: dict[bytes, set[str]] = {}
        for item, text in items:
            for window in windows(text, size):
                owners.setdefault(window, set()).add(item)
        self.parts = []
        for block, chosen in (
            (3, sorted(w for w in owners if len(w) < SHORT)),
            (8, sorted(w for w in owners if len(w) >= SHORT)),
        ):
            if chosen:
                words = np.array([w.count(b" ") - 1 for w in chosen], dtype=np.int64)
                self.parts.append((Matcher(chosen, block), words, [sorted(owners[w]) for w in chosen]))

    def find(self, texts: list[bytes]) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set[str]]]:
        """Of each text: number of words, hit word spans (end exclusive, disjoint), items."""
        norm = normalise(texts)
        starts = np.flatnonzero(norm[:-1] == 0x20) + 1  # of words and of edges
        starts = starts[starts < len(norm)]
        edges = np.flatnonzero(norm[starts] == _EDGE)  # numbers of the edges among them
        first = np.concatenate([[0], edges[:-1] + 1]) if len(edges) else np.zeros(0, np.int64)
        counts = edges - first
        touched = np.zeros(len(starts) + 1, dtype=np.int64)
        items: list[set[str]] = [set() for _ in texts]
        for matcher, words, owners in self.parts:
            where, numbers = matcher.search(norm)
            begin = np.searchsorted(starts, where + 1)
            np.add.at(touched, begin, 1)
            np.add.at(touched, begin + words[numbers], -1)
            for doc, k in zip(np.searchsorted(edges, begin).tolist(), numbers.tolist(), strict=True):
                items[doc].update(owners[k])
        hit = np.cumsum(touched)[:-1] > 0
        hit[edges] = False
        change = np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        for a, b in zip(np.flatnonzero(change == 1).tolist(), np.flatnonzero(change == -1).tolist(), strict=True):
            doc = int(np.searchsorted(edges, a))
            spans[doc].append((a - int(first[doc]), b - int(first[doc])))
        return counts, spans, items


_SPANS = T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("end", T.IntegerType())]))


#: The tables of the block that a worker process searched last, by the block's name.
_TABLES: dict[str, Benchmark] = {}


def _table(name: str, items: list[tuple[str, bytes]], window: int) -> Benchmark:
    """Tables of a block, built once by each worker process and kept for its later tasks."""
    if name not in _TABLES:
        _TABLES.clear()
        _TABLES[name] = Benchmark(items, window)
    return _TABLES[name]


def _blocks(benchmark: DataFrame, item: str, text: str, limit: int) -> Iterator[tuple[list[tuple[str, bytes]], bool]]:
    """The items in blocks of ``limit`` bytes, and whether a block is the last.

    Rows come to the driver one partition after another; two blocks are in memory at most.
    """
    rows = benchmark.select(F.col(item).cast("string").alias("i"), F.encode(text, "UTF-8").alias("t"))
    block: list[tuple[str, bytes]] = []
    used = 0
    for row in rows.where("t is not null").toLocalIterator():
        size = len(row["t"])
        if block and used + size > limit:
            yield block, False
            block, used = [], 0
        block.append((row["i"], bytes(row["t"])))
        used += size
    yield block, True


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    keep: list[str] | None = None,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Columns ``keep`` (default: all) of the documents and what they share with the benchmark.

    ``n_words`` (long), ``n_hit`` (long: words inside an occurrence of a window),
    ``hit_spans`` (array of word positions ``first``, ``end``, end exclusive) and
    ``hit_items`` (sorted array of item ids as strings).

    Null texts have no words and items without words no window. A null item id
    does not occur in ``hit_items``, but its windows are hit. Repeated items count
    once. Document columns with the names of the new ones are replaced. An empty
    benchmark hits nothing. Benchmarks larger than ``block_bytes`` are searched in
    several passes over the documents, each of which is written before the next.
    """
    own = [c for c in docs.columns if c.lower() not in {"n_words", "n_hit", "hit_spans", "hit_items"}]
    wanted = own if keep is None else [c for c in own if c in keep]
    out = docs.select(*[F.col(f"`{c}`") for c in own])
    fields = [("n_words", T.LongType()), ("hit_spans", _SPANS), ("hit_items", T.ArrayType(T.StringType()))]
    carried: list[str] = []
    for block, last in _blocks(benchmark, item_id, item_text, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)  # block_bytes at most, or one item

        def make(shared=shared, name=uuid.uuid4().hex):
            table = _table(name, shared.value, window)

            def run(texts: common.Texts) -> list:
                counts, spans, items = table.find(texts.encoded())
                named = [sorted(x for x in i if x is not None) for i in items]
                return [counts, spans, named]

            return run

        out = common.with_text_columns(out, text, fields, make, [*(wanted if last else own), *carried])
        if carried:
            both = F.concat("__hit_spans", "hit_spans")
            out = out.withColumns(
                {"hit_spans": _merged(both), "hit_items": F.array_sort(F.array_union("__hit_items", "hit_items"))}
            ).drop(*carried)
        if not last:
            carried = ["__hit_spans", "__hit_items"]
            out = cut(out.withColumnsRenamed({c[2:]: c for c in carried}).drop("n_words"))
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return out.select(*[F.col(f"`{c}`") for c in wanted], "n_words", n_hit.alias("n_hit"), "hit_spans", "hit_items")


def _merged(spans):
    """Column: spans in order, overlapping and touching ones as one."""
    empty = F.array().cast("array<struct<first:int,end:int>>")

    def add(done, span):
        last = F.element_at(done, -1)
        joined = F.concat(
            F.slice(done, F.lit(1), F.size(done) - 1),
            F.array(F.struct(last["first"].alias("first"), F.greatest(last["end"], span["end"]).alias("end"))),
        )
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= span["first"]), joined).otherwise(
            F.concat(done, F.array(span))
        )

    return F.aggregate(F.array_sort(spans), empty, add)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents without any benchmark window, with their own columns."""
    apart, back = common.set_aside(docs, ["n_words", "n_hit", "hit_spans", "hit_items"])
    found = find(apart, benchmark, back.get(text, text), **options)
    return common.restored(found.where("n_hit = 0"), docs, back)
