"""Removal of repeated substrings by merging Burrows-Wheeler transforms.

Every string of ``LENGTH`` bytes has an anchor: the n-gram of least rank in it. Strings
that begin next to each other mostly share an anchor; such a stretch of text, some
300 bytes, is one context, and equal strings are in contexts of the same anchor.
Anchors are dealt to ranges by hash. A first exchange sends only hashes: a range
learns which of its anchors occur again, which contexts are equal, and which text
gives each of the different ones. Texts with an anchor that occurs once stay out.

Tasks sort the suffixes of the contexts they hold, one shard for each range, and send
the shards' transforms. A range merges them without their texts and without sorting
suffixes anew: rows of all shards are interleaved by their first bytes, which the
transforms spell out, and the interleave is refined with the pointers that lead from a
row to the next byte's row, twice as deep in each round. Neighbours that a round does
not tell apart have that many bytes in common; intervals that agree in ``LENGTH`` bytes
are the strings that occur again, if their contexts count twice or more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm import common
from basketry.llm.storage import Scratch

LENGTH = 200
#: Bytes of an anchor.
ANCHOR = 32
#: Bytes of text for each range, on average; bytes of contexts that a task holds before it sends shards.
RANGE_BYTES, HELD = 4 << 20, 16 << 20
#: Texts in the sample that tells which anchors are frequent, and in how many of them those are.
SAMPLE, FREQUENT = 8192, 8
#: Ends a context; never part of UTF-8.
END = 0xFF

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _hashed(data: np.ndarray, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams, and the prefix sums and factors that give the hash of any stretch."""
    prefix = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(common._BYTE_VALUES[data] * common.powers(_BASE, len(data)), out=prefix[1:])
    back = common.powers(_INVERSE, len(data))
    return common.mix((prefix[anchor:] - prefix[:-anchor]) * back[: len(data) - anchor + 1]), prefix, back


def _candidates(grams: np.ndarray) -> np.ndarray:
    """Every eighth n-gram by hash; of the others none is an anchor where there is one of these."""
    return grams & np.uint64(7) == 0


def _order(grams: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The rank of anchors in the upper 32 bits: candidates, frequent candidates, others; each by hash."""
    out = (grams >> np.uint64(34)) << np.uint64(32)
    chosen = _candidates(grams)
    out[~chosen] |= np.uint64(1 << 63)
    if len(frequent):
        at = np.flatnonzero(chosen)
        place = np.minimum(np.searchsorted(frequent, grams[at]), len(frequent) - 1)
        out[at[frequent[place] == grams[at]]] |= np.uint64(1 << 62)
    return out


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    blocks = np.concatenate([values, np.full(-len(values) % width, ~np.uint64(0))]).reshape(-1, width)
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    onward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(onward[:n], upto[width - 1 : width - 1 + n])


class Stretches:
    """Runs of string starts with one anchor: ``text``, ``first`` start, ``count`` of starts, hashes of ``anchor`` and ``content``."""

    def __init__(self, texts: common.Texts, frequent: np.ndarray, length: int, anchor: int) -> None:
        data = texts.bytes
        starts = np.maximum(np.diff(texts.offsets) - length + 1, 0)
        total = int(starts.sum())
        self.first = self.count = self.text = np.zeros(0, np.int64)
        self.anchor = self.content = np.zeros(0, np.uint64)
        if not total:
            return
        grams, prefix, back = _hashed(data, anchor)
        # of equal ranks the first place wins
        lowest = _sliding_minimum(_order(grams, frequent) | np.arange(len(grams), dtype=np.uint64), length - anchor + 1)
        text = np.repeat(np.arange(len(starts)), starts)
        at = np.arange(total) - np.repeat(np.cumsum(starts) - starts - texts.offsets[:-1], starts)
        place = (lowest[at] & np.uint64((1 << 32) - 1)).astype(np.int64)
        edge = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        first, self.text = at[edge], text[edge]
        self.count = np.diff(np.append(edge, total))
        self.anchor = common.mix(grams[place[edge]])  # anchors are small hashes, their own bits would deal them unevenly
        self.content = common.mix((prefix[first + self.count - 1 + length] - prefix[first]) * back[first] + self.count.astype(np.uint64))
        self.first = first - texts.offsets[self.text]


def frequent_anchors(texts: DataFrame, number: int, length: int, anchor: int) -> np.ndarray:
    """Hashes of n-grams that many texts have, from a sample of some ``SAMPLE`` of the ``number`` texts (``key``, ``text``).

    They come last in the order of anchors, so that a string across the edge of a common
    passage has an anchor outside of it, not one that a million other strings have too.
    The order decides how work is dealt, never which strings are found equal.
    """
    sample = texts.where(F.pmod("key", F.lit(max(1, number // SAMPLE))) == 0).dropDuplicates(["key"])

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                found = _hashed(np.frombuffer(text.as_buffer(), dtype=np.uint8), anchor)[0]
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(found[_candidates(found)]).view(np.int64))], names=["gram"])

    counted = sample.select("text").mapInArrow(grams, "gram long").groupBy("gram").agg(F.count("*").alias("n"))
    # an eighth of an eighth of the sample's bytes at most
    return np.sort(counted.where(F.col("n") >= FREQUENT).select("gram").toArrow()["gram"].to_numpy().view(np.uint64))


# --- transforms ------------------------------------------------------------------


def refine(order: np.ndarray, rank: np.ndarray, open_: np.ndarray, after: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sort rows of equal rank, which stand at the places ``open_`` of ``order``, by what ``after`` says of them.

    ``rank`` is the first place of the rows that are not told apart; it and ``order`` are
    changed. Returns the places still open, and of these where the one before is no different.
    """
    rows = order[open_]
    key = (rank[rows].astype(np.uint64) << np.uint64(32)) | after(rows).astype(np.uint64)
    inner = np.argsort(key, kind="stable")
    rows, key = rows[inner], key[inner]
    same = np.concatenate([[False], key[1:] == key[:-1]])
    order[open_] = rows
    rank[rows] = np.maximum.accumulate(np.where(same, 0, open_))
    many = same | np.concatenate([same[1:], [False]])
    return open_[many], open_[same]


def begin(key: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``order``, ``rank``, open places and places like the one before, by a first key."""
    order = np.argsort(key, kind=kind).astype(np.int64)
    rank = np.zeros(len(key), dtype=np.int64)
    return order, rank, *refine(order, rank, np.arange(len(key)), lambda rows: _dense(key, order))


def _dense(key: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Of the rows in their order, a small number that grows with the key."""
    sorted_ = key[order]
    return np.cumsum(np.concatenate([[0], sorted_[1:] != sorted_[:-1]]))


def transform(contexts: list[bytes]) -> bytes:
    """The Burrows-Wheeler transform of different contexts, which must be in order with their ends.

    Each context is a cycle of its own: before its first byte comes its end. The k-th end
    in the transform belongs to the k-th context, as in the sorted first bytes.
    """
    data = np.frombuffer(b"".join(c + bytes([END]) for c in contexts), dtype=np.uint8)
    n = len(data)
    symbol = data.astype(np.uint64)
    ends = np.flatnonzero(data == END)
    symbol[ends] += np.arange(len(ends), dtype=np.uint64)
    values = END + len(ends) + 1
    depth = 1
    key = symbol.copy()
    while values ** (depth + 1) < 1 << 63 and depth < n:
        # what follows an end has no say: ends differ
        key *= np.uint64(values)
        key[: n - depth] += symbol[depth:]
        depth += 1
    order, rank, open_, _ = begin(key, "quicksort")
    while len(open_):
        shift = depth
        open_, _ = refine(order, rank, open_, lambda rows: rank[rows + shift])
        depth *= 2
    before = np.concatenate([[END], data[:-1]]).astype(np.uint8)
    return before[order].tobytes()


class Merged:
    """The interleave of the rows of several transforms, refined to a depth.

    ``pointers[i]`` leads from a row to that of the suffix 2^i bytes shorter, ``order`` are
    the rows in the merged order, ``agree[i]`` is a depth to which the suffixes at the
    places i - 1 and i are known to agree: at least 8, 16, 32, .. and the whole depth, or 0.
    """

    def __init__(self, transforms: list[np.ndarray], depth: int) -> None:
        follow, first, self.ends = [], [], []
        base = 0
        for t in transforms:
            shorter = np.argsort(t, kind="stable")  # the k-th of a byte in first place is the k-th in the transform
            follow.append(shorter + base)
            first.append(t[shorter])
            base += len(t)
            self.ends.append(np.arange(base - int((t == END).sum()), base))
        spelt = np.concatenate(first).astype(np.uint64)
        self.pointers = [np.concatenate(follow).astype(np.int32)]
        for bits in (8, 16, 32):  # 1, 2, 4 bytes become 2, 4, 8
            spelt = (spelt << np.uint64(bits)) | spelt[self.pointers[-1]]
            self.pointers.append(self.pointers[-1][self.pointers[-1]])
        reached = 8
        # rows of a shard are in order already, so that this merges runs
        self.order, rank, open_, alike = begin(spelt, "stable")
        self.agree = np.zeros(base, dtype=np.int32)
        self.agree[alike] = reached
        while reached < depth and len(open_):
            if 2 * reached <= depth:
                pointer, reached = self.pointers[-1], 2 * reached
                if 2 * reached <= depth:
                    self.pointers.append(pointer[pointer])
            else:
                pointer, reached = self.step(depth - reached), depth
            open_, alike = refine(self.order, rank, open_, lambda rows: rank[pointer[rows]])
            self.agree[alike] = reached

    def step(self, size: int) -> np.ndarray:
        """Pointers to the suffixes ``size`` bytes shorter."""
        out = None
        for i, pointer in enumerate(self.pointers):
            if size >> i & 1:
                out = pointer if out is None else pointer[out]
        return out

    def starts(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of the first ``counts`` suffixes of each context: context, number of the suffix, row."""
        contexts = np.argsort(-counts, kind="stable")
        row = np.concatenate(self.ends)[contexts]
        parts: list[list[np.ndarray]] = [[], [], []]
        for k in range(int(counts.max(initial=0))):
            going = int(np.searchsorted(-counts[contexts], -k, side="left"))
            contexts, row = contexts[:going], self.pointers[0][row[:going]]
            for part, values in zip(parts, (contexts, np.full(going, k), row), strict=True):
                part.append(values)
        return tuple(np.concatenate([np.zeros(0, np.int64), *p]).astype(np.int64) for p in parts)


def repeated(transforms: list[np.ndarray], weights: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of starts whose strings occur twice or more: context, first start, last start.

    ``weights`` says how often each context occurs, ``counts`` how many starts it has.
    """
    if not transforms:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    merged = Merged(transforms, length)
    context, number, row = merged.starts(counts)
    weight = np.zeros(len(merged.order), dtype=np.int64)
    weight[row] = weights[context]
    edge = np.flatnonzero(merged.agree < length)  # where intervals begin
    total = np.add.reduceat(weight[merged.order], edge)
    many = np.zeros(len(weight), dtype=bool)
    many[merged.order] = np.repeat(total >= 2, np.diff(np.append(edge, len(weight))))
    chosen = many[row]
    place = np.sort((context[chosen] << 16) | number[chosen])
    new = np.flatnonzero(np.concatenate([[True], np.diff(place) != 1])) if len(place) else np.zeros(0, np.int64)
    last = np.append(new[1:], len(place))[: len(new)] - 1
    return place[new] >> 16, place[new] & 0xFFFF, place[last] & 0xFFFF


# --- Spark jobs --------------------------------------------------------------------

_ENTRY = [("anchor", np.uint32), ("content", np.uint64), ("key", np.int64), ("first", np.int32), ("count", np.uint16)]
_PACKED = "range long, " + ", ".join(f"{name} binary" for name, _ in _ENTRY)


def _joined(batches: list[pa.RecordBatch] | pa.Table, name: str, kind) -> np.ndarray:
    column = batches[name]
    return np.frombuffer(b"".join(v.as_buffer().to_pybytes() for v in column), dtype=kind)


def signs(texts: DataFrame, ranges: int, frequent: np.ndarray, length: int, anchor: int) -> DataFrame:
    """All stretches of ``texts`` (``key``, ``text``) as packed entries, one row for each range and chunk of texts.

    Of equal texts a task sends two.
    """
    shared = texts.sparkSession.sparkContext.broadcast(frequent)  # some MB, see frequent_anchors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            keys = np.asarray(batch.column(0))
            few = np.zeros(len(keys), dtype=bool)
            for i, k in enumerate(keys.tolist()):
                seen[k] = seen.get(k, 0) + 1
                few[i] = seen[k] <= 2
            keys, column = keys[few], common.string_column(batch.column(1)).filter(pa.array(few))
            for start, stop in common.chunks(column, 4 * common.CHUNK_BYTES):
                parts = []
                for a, b in common.chunks(column.slice(start, stop - start)):
                    s = Stretches(common.Texts(column.slice(start + a, b - a)), shared.value, length, anchor)
                    parts.append((s.anchor, s.content, keys[start + a + s.text], s.first, s.count))
                found, *rest = (np.concatenate(x) for x in zip(*parts, strict=True))
                where = ((found >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
                order = np.argsort(where, kind="stable")
                where, columns = where[order], [x[order].astype(t) for x, (_, t) in zip([found, *rest], _ENTRY, strict=True)]
                edge = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]])) if len(where) else np.zeros(0, np.int64)
                stops = np.append(edge[1:], len(where))[: len(edge)]
                packed = [pa.array([x[i:j].tobytes() for i, j in zip(edge, stops, strict=True)], pa.binary()) for x in columns]
                yield pa.RecordBatch.from_arrays([pa.array(where[edge].astype(np.int64)), *packed], names=["range", *(n for n, _ in _ENTRY)])
        common.release()

    return texts.mapInArrow(run, _PACKED)


def recurring(entries: DataFrame) -> DataFrame:
    """Of each range the entries whose anchors occur again, by content, once each; ``weight``: 1 or, for more, 2.

    The first entry of a content is the one whose text the range will ask for.
    """

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        anchor, content, text, first, count = (_joined(table, name, kind) for name, kind in _ENTRY)
        _, place, uses = np.unique(anchor, return_inverse=True, return_counts=True)
        kept = np.flatnonzero(uses[place] > 1)
        kept = kept[np.lexsort((first[kept], text[kept], content[kept]))]
        content, text, first, count, anchor = content[kept], text[kept], first[kept], count[kept], anchor[kept]
        new = np.concatenate([[True], content[1:] != content[:-1]]) if len(kept) else np.zeros(0, bool)
        weight = np.minimum(np.diff(np.append(np.flatnonzero(new), len(kept))), 2)[np.cumsum(new) - 1].astype(np.uint8) if len(kept) else np.zeros(0, np.uint8)
        once = new.copy()
        once[1:] |= (text[1:] != text[:-1]) | (first[1:] != first[:-1])
        columns = [x[once] for x in (anchor, content, text, first, count, weight)]
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), *(pa.array([c.tobytes()], pa.binary()) for c in columns)], names=["range", *(n for n, _ in _ENTRY), "weight"])

    return entries.groupBy("range").applyInArrow(run, _PACKED + ", weight binary")


def wanted(counted: DataFrame) -> DataFrame:
    """``key`` and the contexts that its text gives: ``w``, an array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                _, content, text, first, count = (_joined(row, name, kind) for name, kind in _ENTRY)
                new = np.concatenate([[True], content[1:] != content[:-1]]) if len(content) else np.zeros(0, bool)
                where = np.full(int(new.sum()), row["range"][0].as_py())
                weight = _joined(row, "weight", np.uint8)[new].astype(np.int32)
                columns = [text[new], where, content[new].view(np.int64), first[new], count[new].astype(np.int32), weight]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "range", "content", "first", "count", "weight"])

    rows = counted.mapInArrow(run, "key long, range long, content long, first int, count int, weight int")
    return rows.groupBy("key").agg(F.collect_list(F.struct("range", "content", "first", "count", "weight")).alias("w"))  # at most some for 50 bytes of text


def shards(texts: DataFrame, length: int, held: int = HELD) -> DataFrame:
    """Transforms of the contexts that texts (``text``, ``w``) give, one row for each range and ``held`` bytes of contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[bytes, int, int, int]]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for where, contexts in waiting.items():
                contexts.sort()  # with their ends
                text, content, count, weight = zip(*contexts, strict=True)
                values = [transform([t[:-1] for t in text]), np.array(content, np.int64).tobytes(), np.array(count, np.uint16).tobytes(), np.array(weight, np.uint8).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([where], pa.int64()), *(pa.array([v], pa.binary()) for v in values)], names=["range", "transform", "content", "count", "weight"])
            waiting.clear()

        for batch in batches:
            lists = batch.column(1)
            fields = [np.asarray(lists.values.field(k)) for k in range(5)]
            edges = lists.offsets.to_pylist()
            for row, text in enumerate(batch.column(0)):
                text = text.as_buffer().to_pybytes()
                for i in range(edges[row], edges[row + 1]):
                    where, content, first, count, weight = (int(f[i]) for f in fields)
                    context = text[first : first + count - 1 + length] + bytes([END])
                    waiting.setdefault(where, []).append((context, content, count, weight))
                    size += len(context)
                if size > held:
                    yield from flush()
                    size = 0
        yield from flush()
        common.release()

    return texts.mapInArrow(run, "range long, transform binary, content binary, count binary, weight binary")


def spans(made: DataFrame, counted: DataFrame, length: int) -> DataFrame:
    """``key``, ``first``, ``end``: bytes of texts that strings which occur again cover; spans may overlap."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        transforms = [np.frombuffer(v.as_buffer(), dtype=np.uint8) for v in left["transform"]]
        content = _joined(left, "content", np.uint64)
        context, low, high = repeated(transforms, _joined(left, "weight", np.uint8).astype(np.int64), _joined(left, "count", np.uint16).astype(np.int64), length)
        # every place of a context has the context's spans
        order = np.argsort(content[context], kind="stable")
        known, low, high = content[context][order], low[order], high[order]
        there, text, first = _joined(right, "content", np.uint64), _joined(right, "key", np.int64), _joined(right, "first", np.int32)
        at = np.searchsorted(known, there, side="left")
        size = np.searchsorted(known, there, side="right") - at
        entry = np.repeat(at - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        begin_ = np.repeat(first, size)
        common.release()
        return pa.table({"key": np.repeat(text, size), "first": (begin_ + low[entry]).astype(np.int32), "end": (begin_ + high[entry] + length).astype(np.int32)})

    return made.groupBy("range").cogroup(counted.groupBy("range")).applyInArrow(run, "key long, first int, end int")


def united(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans in order, overlapping and touching ones as one."""
    if not len(first):
        return first, end
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], first[1:] > end[:-1]])
    return first[new], end[np.append(np.flatnonzero(new)[1:], len(end)) - 1]


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    length: int = LENGTH,
    anchor: int = ANCHOR,
    keep: list[str] | None = None,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Columns ``keep`` (default: all) and the text's bytes without those of repeated strings.

    A byte goes if a string of ``length`` bytes covers it that starts anywhere else too, in
    the same or another row. ``n_bytes``, ``n_removed``, ``n_spans`` (long: removed runs, touching
    ones as one), ``removed`` (array of ``first``, ``end``, end exclusive) and ``kept`` (binary; the
    rest may begin or end inside a character). A null text is an empty one; repeated rows
    are texts of their own, so both lose what they share. Columns of the names of the new ones
    are replaced. Equal texts, contexts and n-grams are known by 64-bit hashes; a hash
    shared by unlike n-grams only costs time.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    new = ["n_bytes", "n_removed", "n_spans", "removed", "kept"]
    own = [c for c in (docs.columns if keep is None else keep) if c.lower() not in {*new, "__text", "__key", "__same", "__spans"}]
    raw = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    keyed = docs.select(*[F.col(f"`{c}`") for c in own], raw.alias("__text"), F.xxhash64(raw).alias("__key"))
    texts = keyed.select(F.col("__key").alias("key"), F.col("__text").alias("text")).where(F.octet_length("text") >= length)
    size = texts.agg(F.count("*").alias("texts"), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("bytes")).first()
    ranges = max(1, -(-size["bytes"] // RANGE_BYTES))
    entries = signs(texts, ranges, frequent_anchors(texts, size["texts"], length, anchor), length, anchor)
    counted = scratch.cut(recurring(entries))
    sources = texts.dropDuplicates(["key"]).join(wanted(counted), "key").select("text", "w")
    found = scratch.cut(spans(shards(sources, length), counted, length))
    scratch.drop(counted)
    lists = scratch.cut(found.groupBy(F.col("key").alias("__same")).agg(F.collect_list(F.struct("first", "end")).alias("__spans")))  # at most some for 50 bytes of text
    scratch.drop(found)
    joined = keyed.join(lists, F.col("__key") == F.col("__same"), "left").select(*[F.col(f"`{c}`") for c in own], "__spans", "__text")
    fields = [
        *[T.StructField(n, T.LongType()) for n in new[:3]],
        T.StructField("removed", T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
        T.StructField("kept", T.BinaryType()),
    ]
    schema = T.StructType([*(joined.schema[i] for i in range(len(own))), *fields])

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, column = batch.column(len(own)), batch.column(len(own) + 1)
            numbers: list[list] = [[], [], [], [], []]
            for covered, value in zip(lists, column, strict=True):
                data = value.as_buffer().to_pybytes()
                if covered.is_valid:
                    first, end = united(np.asarray(covered.values.field(0)), np.asarray(covered.values.field(1)))
                    first, end = first.tolist(), end.tolist()
                    data_kept = b"".join(data[a:b] for a, b in zip([0, *end], [*first, len(data)], strict=True))
                else:
                    first, end, data_kept = [], [], data
                row = (len(data), len(data) - len(data_kept), len(first), [{"first": a, "end": b} for a, b in zip(first, end, strict=True)], data_kept)
                for values, v in zip(numbers, row, strict=True):
                    values.append(v)
            kinds = [pa.int64()] * 3 + [pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])), pa.binary()]
            yield pa.RecordBatch.from_arrays(list(chain((batch.column(i) for i in range(len(own))), (pa.array(v, k) for v, k in zip(numbers, kinds, strict=True)))), names=[*own, *new])
        common.release()

    return joined.mapInArrow(cut_out, schema)
