"""Fuzzy line deduplication by MinHash.

A line is the set of its character n-grams. Signatures of ``BANDS`` bands of
``ROWS`` minima bring similar lines together: two lines of similarity s share a
band with probability 1 - (1 - s^ROWS)^BANDS, 99.7 % at 0.75 and more above. Most lines
that share a band are not similar, so every entry of a band carries a sketch, two
bits of each minimum: lines of a band are compared if their sketches agree in
``AGREE`` places, which two lines of similarity 0.75 miss with a probability below 0.0001.

No task sends the pairs of a band. First each line is paired with the one before it
in the band whose sketch agrees most; these pairs are verified by exact Jaccard
similarity and the links joined by distributed union-find. Bands whose agreeing
lines are one component then are settled. The lines of any other meet in one
task, which compares those of different components and sends links only. The
first line of a component in the corpus stays.

Entries are dealt to ranges of band keys, packed. Bands that very many lines share are
known from a sample and spread over tasks; one of more than ``SMALL_BAND`` lines
that is not settled goes through an exact prefix filter.

Equal lines are one line from the start: they share an id, the hash of their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm import common
from basketry.llm.components import components
from basketry.llm.storage import Scratch

GRAM = 5
BANDS, ROWS = 16, 4
NUMERATOR = 75
#: Places of 64 in which the sketches of lines must agree to be compared.
AGREE = 40
#: Bits of the sketch of needed lines that is sent to all tasks; lines outside of it are not shuffled.
SKETCH_BITS = 27
#: Bytes of text for each range of band keys, on average; bytes of text whose entries are packed together.
RANGE_BYTES, PACK_BYTES = 4 << 20, 4 << 20
#: Texts in the sample that tells which bands are hot, and different lines that make one hot there.
SAMPLE, HOT = 4096, 8
#: Documents to edit and lines to drop from them that are sent to all tasks (some 100 bytes and 8 bytes each);
#: with more of either, documents are joined with their lines by a shuffle.
MOST_EDITED, MOST_DROPPED = 1 << 19, 1 << 22
#: Lines of a band that are compared with each other by sketch; larger bands go through the prefix filter.
SMALL_BAND = 2048
#: Bytes of lines that one step hashes or compares at a time.
STEP = 1 << 15
#: Bits of the map of a line's n-grams that tells most unlike lines apart before they are compared.
MAP_BITS = 2048
#: Rows and bytes of the lines of unsettled bands that go to one call, on average; pairs of them in one step.
BUCKET_ROWS, BUCKET_BYTES, PAIRS = 1 << 13, 4 << 20, 1 << 16

_MULTIPLIERS = np.random.default_rng(5).integers(1, 2**32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_SHIFTS = np.random.default_rng(6).integers(1, 2**32, BANDS * ROWS, dtype=np.uint32)
_GRAM_BASE = np.uint64(0x9E3779B97F4A7C15)
_ID_BASE = 0x2545F4914F6CDD1D
_ID_INVERSE = pow(_ID_BASE, -1, 1 << 64)
_ID_POWERS, _ID_BACK = common.powers(_ID_BASE, STEP), common.powers(_ID_INVERSE, STEP + 1)
#: First bytes that a line of white space can have: ASCII's, and any of other characters.
_MAY_BE_SPACE = (np.arange(256) <= 32) | (np.arange(256) >= 127)


def split(column: pa.Array) -> pa.ListArray:
    """The lines of each text; a null text is an empty line."""
    return pc.split_pattern(pc.fill_null(column, ""), "\n")


def line_ids(lines: pa.Array) -> np.ndarray:
    """A 64-bit hash of each line's bytes; 0 for a line of white space only, which is no duplicate of any."""
    texts = common.Texts(lines)
    ids = np.zeros(len(texts), dtype=np.uint64)
    starts, ends = texts.offsets[:-1], texts.offsets[1:]
    for first, last in common.steps(ends - starts, STEP):
        begin, size = starts[first], ends[last - 1] - starts[first]
        power, back = (_ID_POWERS, _ID_BACK) if size <= STEP else (common.powers(_ID_BASE, size), common.powers(_ID_INVERSE, size + 1))
        prefix = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(common._BYTE_VALUES[texts.bytes[begin : begin + size]] * power[:size], out=prefix[1:])
        at, stop = starts[first:last] - begin, ends[first:last] - begin
        ids[first:last] = (prefix[stop] - prefix[at]) * back[at] + (stop - at).astype(np.uint64)
    ids = common.mix(ids)
    ids[starts == ends] = 0
    low = np.flatnonzero(starts < ends)
    low = low[_MAY_BE_SPACE[texts.bytes[starts[low]]]]
    ids[low[np.asarray(pc.utf8_is_space(texts.column.take(pa.array(low))), dtype=bool)]] = 0
    return ids.view(np.int64)


def _points(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of lines, one after the other, and how many each has; a line shorter than an n-gram is filled up."""
    texts = common.Texts(lines)
    ascii = texts.bytes.max(initial=0) < 128
    if not ascii or np.diff(texts.offsets).min(initial=GRAM) < GRAM:
        lines = pc.utf8_rpad(lines, GRAM, "\0")
        texts = common.Texts(lines)
    if ascii:
        return texts.bytes, np.diff(texts.offsets)
    return np.frombuffer(texts.bytes.tobytes().decode().encode("utf-32-le"), dtype=np.uint32), np.asarray(pc.utf8_length(lines), dtype=np.int64)


def _hashed(lines: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """32-bit hashes of the n-grams of lines, those across two lines too; the first of each line and their number."""
    points, sizes = _points(lines)
    points = points.astype(np.uint64)
    count = len(points) - GRAM + 1
    hashes = points[GRAM - 1 :].copy()
    for k in reversed(range(GRAM - 1)):
        hashes *= _GRAM_BASE
        hashes += points[k : count + k]
    return (common.mix(hashes) >> np.uint64(32)).astype(np.uint32), np.cumsum(sizes) - sizes, sizes - GRAM + 1


def signatures(lines: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The keys of every line's bands, ``BANDS`` columns, and its sketch: the two low bits of its minima, as two numbers.

    A line shorter than an n-gram is one n-gram.
    """
    lines = lines if isinstance(lines, pa.Array) else pa.array(lines, pa.string())
    out, sketch = np.zeros((len(lines), BANDS), dtype=np.uint64), np.zeros((len(lines), 2), dtype=np.uint64)
    numbers = np.arange(BANDS * ROWS, dtype=np.uint64).reshape(BANDS, ROWS)
    for start, stop in common.chunks(lines, STEP):
        grams, first, count = _hashed(lines.slice(start, stop - start))
        bounds = np.stack([first, first + count], 1).ravel()[:-1]  # n-grams across two lines are left out
        least = np.empty((BANDS * ROWS, stop - start), dtype=np.uint32)
        value = np.empty_like(grams)
        for k in range(BANDS * ROWS):
            np.multiply(grams, _MULTIPLIERS[k], out=value)
            value += _SHIFTS[k]
            least[k] = np.minimum.reduceat(value, bounds)[::2]
        for bit in range(2):
            bits = np.packbits((least & np.uint32(1 << bit)).astype(bool), axis=0, bitorder="little")
            sketch[start:stop, bit] = np.ascontiguousarray(bits.T).view("<u8")[:, 0]
        rows = least.astype(np.uint64).reshape(BANDS, ROWS, -1)
        key = np.zeros((BANDS, stop - start), dtype=np.uint64)
        for row in range(ROWS):
            key = common.mix(key + rows[:, row] + numbers[:, row, None])
        out[start:stop] = key.T
    return out, sketch


def similar(left: pa.Array, right: pa.Array, numerator: int = NUMERATOR) -> np.ndarray:
    """Which pairs of lines are similar enough, by the exact sets of their n-grams."""
    out = np.zeros(len(left), dtype=bool)
    sizes = np.asarray(pc.binary_length(left), dtype=np.int64) + np.asarray(pc.binary_length(right), dtype=np.int64)
    for start, stop in common.steps(sizes, STEP):
        n = stop - start
        lines = pa.concat_arrays([left.slice(start, n), right.slice(start, n)])
        points, sizes_of = _points(lines)
        present = np.zeros(int(points.max()) + 1, dtype=bool)
        present[points] = True
        base = int(present.sum())
        bits = (base**GRAM - 1).bit_length()
        if bits + n.bit_length() > 62 or pc.any(pc.match_substring(lines, "\0")).as_py():  # rare: no whole number holds all of it
            for i, (x, y) in enumerate(zip(lines.slice(0, n).to_pylist(), lines.slice(n).to_pylist(), strict=True), start):
                x, y = grams(x), grams(y)
                out[i] = 100 * len(x & y) >= numerator * len(x | y)
            continue
        digits = (np.cumsum(present) - 1)[points]
        count = len(digits) - GRAM + 1
        value = digits[:count].copy()
        for k in range(1, GRAM):
            value *= base
            value += digits[k : count + k]
        inside = np.arange(count) < np.repeat(np.cumsum(sizes_of) - GRAM + 1, sizes_of)[:count]
        line = np.repeat(np.arange(2 * n), sizes_of - GRAM + 1)
        key = (((line % n) << bits) + value[inside]) * 2 + (line >= n)  # pair, n-gram, side
        key.sort()
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
        key >>= 1
        pair = key >> bits
        both = np.bincount(pair[1:][key[1:] == key[:-1]], minlength=n)
        out[start:stop] = 100 * both >= numerator * (np.bincount(pair, minlength=n) - both)
    return out


def bitmaps(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each line ``MAP_BITS`` bits, of which its n-grams set those they hash to, and how many n-grams it has at most."""
    maps, most = np.zeros((len(lines), MAP_BITS // 64), dtype=np.uint64), np.zeros(len(lines), dtype=np.int64)
    for start, stop in common.chunks(lines, STEP):
        hashes, first, count = _hashed(lines.slice(start, stop - start))
        line = np.repeat(np.arange(stop - start), count)
        place = np.arange(len(line)) + np.repeat(first - np.cumsum(count) + count, count)
        for at in range(0, stop - start, 1 << 10):
            part = slice(*np.searchsorted(line, [at, at + (1 << 10)]))
            bits = np.zeros((min(1 << 10, stop - start - at), MAP_BITS), dtype=bool)
            bits[line[part] - at, hashes[place[part]] % np.uint32(MAP_BITS)] = True
            maps[start + at : start + at + len(bits)] = np.packbits(bits, axis=1, bitorder="little").view("<u8")
        most[start:stop] = count
    return maps, most


def possible(maps: np.ndarray, most: np.ndarray, a: np.ndarray, b: np.ndarray, numerator: int = NUMERATOR) -> np.ndarray:
    """Which lines ``a`` and ``b`` can be similar enough: a bit of one that the other lacks is an n-gram that it lacks, or more."""
    left, right = maps[a], maps[b]
    only_a = np.bitwise_count(left & ~right).sum(axis=1, dtype=np.int64)
    only_b = np.bitwise_count(right & ~left).sum(axis=1, dtype=np.int64)
    both = np.minimum(most[a] - only_a, most[b] - only_b)
    return 100 * both >= numerator * (both + only_a + only_b)


_ENTRY = [("key", np.uint32), ("id", np.int64), ("low", np.uint64), ("high", np.uint64)]


def _chosen(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The different lines of some texts that are not blank, and their ids."""
    lines = split(column).flatten()
    ids = line_ids(lines)
    _, at = np.unique(ids, return_index=True)
    at = at[ids[at] != 0]
    return lines.take(pa.array(at)), ids[at]


def hot_bands(texts: DataFrame, number: int) -> np.ndarray:
    """Keys of the bands that many lines share, from a sample of some ``SAMPLE`` of the ``number`` texts."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = common.string_column(batch.column(0))
            for start, stop in common.chunks(column):
                lines, ids = _chosen(column.slice(start, stop - start))
                yield pa.RecordBatch.from_arrays([pa.array(signatures(lines)[0].ravel().view(np.int64)), pa.array(np.repeat(ids, BANDS))], names=["key", "id"])

    some = texts.where(F.pmod(F.xxhash64("text"), F.lit(max(1, number // SAMPLE))) == 0).dropDuplicates(["text"])
    counted = some.mapInArrow(keys, "key long, id long").distinct().groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= HOT)
    return np.sort(counted.select("key").toArrow()["key"].to_numpy().view(np.uint64))  # at most twice as many as the sample has lines


def entries(texts: DataFrame, ranges: int, hot: np.ndarray) -> DataFrame:
    """Band entries of all lines, packed, one row for each range of keys and ``PACK_BYTES`` of text.

    Entries of hot bands go to ranges of their own, dealt by chunk; these numbers are
    larger, and the same modulo ``ranges``.
    """
    shared = texts.sparkSession.sparkContext.broadcast(hot)  # some MB, see hot_bands
    pieces = min(ranges, 16 + ranges // 64)  # of a hot band

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            column = common.string_column(batch.column(0))
            for start, stop in common.chunks(column, PACK_BYTES):
                lines, ids = _chosen(column.slice(start, stop - start))
                keys, sketch = signatures(lines)
                key = keys.ravel()
                where = ((key >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
                if len(known) and len(key):
                    place = np.minimum(np.searchsorted(known, key), len(known) - 1)
                    piece = common.mix(key ^ ids[:1].view(np.uint64)) % np.uint64(pieces) + np.uint64(1)
                    where = where + np.where(known[place] == key, piece * np.uint64(ranges), np.uint64(0))
                order = np.argsort(where, kind="stable")
                where, line = where[order], order // BANDS
                columns = [key[order].astype(np.uint32), ids[line], sketch[line, 0], sketch[line, 1]]
                edge = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]])) if len(where) else np.zeros(0, np.int64)
                stops = np.append(edge[1:], len(where))[: len(edge)]
                packed = [pa.array([x[i:j].tobytes() for i, j in zip(edge, stops, strict=True)], pa.binary()) for x in columns]
                yield pa.RecordBatch.from_arrays([pa.array(where[edge].astype(np.int64)), *packed], names=["range", *(n for n, _ in _ENTRY)])
        common.release()

    return texts.mapInArrow(run, "range long, " + ", ".join(f"{n} binary" for n, _ in _ENTRY))


def agreement(low: np.ndarray, high: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many places the sketches of the rows ``a`` and ``b`` agree."""
    return 64 - np.bitwise_count((low[a] ^ low[b]) | (high[a] ^ high[b])).astype(np.int16)


def nearest_before(first: np.ndarray, size: np.ndarray, low: np.ndarray, high: np.ndarray, step: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of groups of rows, given by first row and size: pairs of a row and the one before it in its group that agrees most.

    Also which groups have other pairs that agree enough. Rows without any such pair are left out.
    """
    parents, children, more = [], [], np.zeros(len(first), dtype=bool)
    for n in np.unique(size).tolist():
        where = np.flatnonzero(size == n)
        together = max(1, step // (n * n))
        for at in range(0, len(where), together):
            groups = where[at : at + together]
            base = first[groups][:, None]
            count = np.zeros(len(groups), dtype=np.int64)
            edges = np.zeros(len(groups), dtype=np.int64)
            for child in range(1, n):
                value = agreement(low, high, base + np.arange(child), base + child)
                count += (value >= AGREE).sum(axis=1)
                best = value.argmax(axis=1)
                good = value[np.arange(len(groups)), best] >= AGREE
                edges += good
                parents.append(base[good, 0] + best[good])
                children.append(base[good, 0] + child)
            more[groups] = count > edges
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *parents]), np.concatenate([none, *children]), more


def candidates(texts: DataFrame) -> DataFrame:
    """Pairs of lines to compare first, and members of bands that may need more.

    ``a``, ``b`` are ids of lines. With ``band`` 0 they are a pair. Else ``a`` is a line of the
    band, ``low`` and ``high`` are its sketch, and ``b`` is the first line that its task knows of it.
    """
    size = texts.agg(F.count("*").alias("texts"), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("bytes")).first()
    ranges = max(1, -(-size["bytes"] // RANGE_BYTES))
    small, names = SMALL_BAND, ["a", "b", "band", "low", "high"]

    def met(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = key[0].as_py()
        table = pa.Table.from_batches(batches)
        keys, ids, low, high = (np.frombuffer(b"".join(v.as_buffer().to_pybytes() for v in table[n]), dtype=t) for n, t in _ENTRY)
        order = np.argsort((keys.astype(np.uint64) << np.uint64(32)) | ((ids.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(32)))
        keys, ids, low, high = keys[order], ids[order], low[order], high[order]
        new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])])
        keys, ids, low, high = keys[new], ids[new], low[new], high[new]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        size = np.diff(np.append(first, len(keys)))
        whole = where >= ranges  # a hot band, of which other tasks have more
        few = (size > 1) & (size <= small)
        parent, child, more = nearest_before(first[few], size[few], low, high)
        both = np.unique(np.stack([ids[parent], ids[child]], 1), axis=0)
        none = pa.array(np.zeros(len(both), np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), none, none, none], names=names)
        many = (size > small) | whole
        many[np.flatnonzero(few)[more]] = True
        member = np.repeat(many, size)
        band = ((np.uint64(where % ranges + 1) << np.uint64(32)) | keys[member].astype(np.uint64)).view(np.int64)
        columns = [ids[member], np.repeat(ids[first], size)[member], band, low[member].view(np.int64), high[member].view(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)
        if not whole:  # there are few of these, and they are large
            del table, keys, ids, low, high, order, columns
            common.trim()

    dealt = entries(texts, ranges, hot_bands(texts, size["texts"]))
    return dealt.groupBy("range").applyInArrow(met, "a long, b long, band long, low long, high long")


def unsettled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``band``, ``id``, ``low``, ``high``, ``root``, ``n``: lines of the bands whose ``n`` lines are not one component yet."""
    members = members.select("band", F.col("a").alias("id"), "low", "high").dropDuplicates(["band", "id"])
    members = members.join(roots, F.col("id") == F.col("node"), "left").select("band", "id", "low", "high", F.coalesce("root", "id").alias("root"))
    open_bands = members.groupBy("band").agg(F.count("*").alias("n"), F.min("root").alias("least"), F.max("root").alias("most"))
    open_bands = open_bands.where("least <> most").select("band", "n", F.xxhash64("band").alias("__spread"))
    # one more key, so that both sides have an exchange and a hot band can be split
    return members.withColumn("__spread", F.xxhash64("band")).join(open_bands, ["band", "__spread"]).drop("__spread")


def _pairs_within(first: np.ndarray, step: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of a row and one before it in its group, some ``step`` of them at a time; ``first``: of each row, its group's first."""
    before = np.arange(len(first)) - first
    for start, stop in common.steps(before, step):
        number = before[start:stop]
        child = np.repeat(np.arange(start, stop), number)
        yield first[child] + np.arange(len(child)) - np.repeat(np.cumsum(number) - number, number), child


def settled(rest: DataFrame, lines: DataFrame, numerator: int = NUMERATOR) -> DataFrame:
    """Links ``a``, ``b`` between components, from all agreeing pairs of each band; a band, of ``SMALL_BAND`` lines at most, is one task's.

    Several bands go to one call, which compares a pair that they share once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches).combine_chunks()
        order = np.argsort(table["band"].to_numpy(), kind="stable")
        band, ids, roots, low, high = (table[c].to_numpy()[order] for c in ("band", "id", "root", "low", "high"))
        low, high = low.view(np.uint64), high.view(np.uint64)
        known, at, line = np.unique(ids, return_index=True, return_inverse=True)
        texts = table["line"].combine_chunks().take(pa.array(order[at]))
        maps, most = bitmaps(texts)
        part = np.unique(roots, return_inverse=True)[1]
        of = part[at].tolist()
        top = list(range(len(ids)))

        def find(x: int) -> int:
            while top[x] != x:
                top[x] = top[top[x]]
                x = top[x]
            return x

        links = [np.zeros((0, 2), np.int64)]
        edge = np.concatenate([[True], band[1:] != band[:-1]])
        for a, b in _pairs_within(np.maximum.accumulate(np.where(edge, np.arange(len(band)), 0)), PAIRS):
            apart = part[a] != part[b]
            a, b = a[apart], b[apart]
            agree = agreement(low, high, a, b) >= AGREE
            a, b = line[a[agree]], line[b[agree]]
            a, b = np.divmod(np.unique(np.minimum(a, b) * len(known) + np.maximum(a, b)), len(known))
            may = possible(maps, most, a, b, numerator)
            a, b = a[may], b[may]
            for start in range(0, len(a), 256):
                x, y = a[start : start + 256], b[start : start + 256]
                apart = np.array([find(of[i]) != find(of[j]) for i, j in zip(x.tolist(), y.tolist(), strict=True)])
                x, y = x[apart], y[apart]
                good = similar(texts.take(pa.array(x)), texts.take(pa.array(y)), numerator)
                for i, j in zip(x[good].tolist(), y[good].tolist(), strict=True):
                    i, j = sorted((find(of[i]), find(of[j])))
                    top[j] = i
                links.append(np.stack([known[x[good]], known[y[good]]], 1))
        found = np.concatenate(links)
        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    size = lines.agg(F.count("*").alias("lines"), F.coalesce(F.sum(F.octet_length("line").cast("long")), F.lit(0)).alias("bytes")).first()
    rows = rest.count()
    buckets = 1 + rows // BUCKET_ROWS + rows * size["bytes"] // max(1, size["lines"]) // BUCKET_BYTES
    dealt = rest.join(lines, "id").select(F.pmod(F.xxhash64("band"), F.lit(buckets)).alias("bucket"), "band", "id", "root", "low", "high", "line")
    return dealt.groupBy("bucket").applyInArrow(run, "a long, b long")


def _meet(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``a``, ``b``: rows of the same keys whose components differ and whose sizes allow the similarity."""
    left = rows.select(*keys, F.col("id").alias("a"), F.col("root").alias("ra"), F.col("size").alias("sa"), F.col("most").alias("ma"))
    right = rows.select(*keys, F.col("id").alias("b"), F.col("root").alias("rb"), F.col("size").alias("sb"), F.col("most").alias("mb"))
    return left.join(right, keys).where("a < b and ra <> rb and sa <= mb and sb <= ma").select("a", "b")


def remaining(rest: DataFrame, lines: DataFrame, numerator: int = NUMERATOR) -> DataFrame:
    """``a``, ``b``: pairs of different components in large unsettled bands that can be similar.

    Of two similar sets, in any common order of n-grams, the first n - ceil(n * s) + 1
    of each have one in common. That order begins with a band's rarest n-grams, so
    lines of one template meet only by what sets them apart.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [sorted(grams(x)) for x in part.column(3).to_pylist()]
                n = np.array([len(x) for x in sets])
                bands, ids, roots = (np.repeat(np.asarray(part.column(i)), n) for i in range(3))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bands), pa.array(ids), pa.array(roots), pa.array(np.repeat(n, n)), pa.array([g for x in sets for g in x], pa.string())],
                    names=["band", "id", "root", "size", "gram"],
                )

    large = rest.join(lines, "id").select("band", "id", "root", "line")
    each = large.mapInArrow(hashed, "band long, id long, root long, size long, gram string")
    each = each.withColumn("gram", F.xxhash64("gram"))  # n-grams of one hash only make more pairs to verify
    counts = each.groupBy("band", "gram").agg(F.count("*").alias("uses"))
    ordered = each.join(counts, ["band", "gram"]).groupBy("band", "id", "root", "size").agg(F.array_sort(F.collect_list(F.struct("uses", "gram"))).alias("order"))
    length = F.expr(f"cast(size - (size * {numerator} + 99) div 100 + 1 as int)")
    prefix = ordered.select("band", "id", "root", "size", F.expr(f"size * 100 div {numerator}").alias("most"), F.explode(F.slice("order", F.lit(1), length)).alias("p"))
    prefix = prefix.where("p.uses > 1").select("band", "id", "root", "size", "most", F.col("p.gram").alias("gram")).distinct()
    return _meet(prefix, ["band", "gram"]).distinct()


def _known_bits(wanted: DataFrame) -> np.ndarray:
    """A set of 2^``SKETCH_BITS`` bits, two of them set for each id."""
    mask = (1 << SKETCH_BITS) - 1
    places = F.array(F.col("id").bitwiseAND(mask), F.shiftrightunsigned("id", 32).bitwiseAND(mask))
    place = wanted.select(F.explode(F.transform(places, lambda p: p + 1)).alias("p"))
    rows = place.groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    bits = np.zeros(max(1, (1 << SKETCH_BITS) >> 3), dtype=np.uint8)
    for row in rows.toLocalIterator():  # 2^SKETCH_BITS bits in all
        part = np.frombuffer(row["bits"], dtype=np.uint8)
        at = (row["bucket"] - 1) * 4096
        bits[at : at + 4096] = part[: len(bits) - at]
    return bits


def _has(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    out = np.ones(len(ids), dtype=bool)
    for shift in (0, 32):
        place = (ids.view(np.uint64) >> np.uint64(shift)) & np.uint64(len(bits) * 8 - 1)
        out &= (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & np.uint8(1)).astype(bool)
    return out


def _texts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``id``, ``line`` of the lines whose ids are in ``wanted``."""
    shared = texts.sparkSession.sparkContext.broadcast(_known_bits(wanted))  # 2^SKETCH_BITS bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = common.string_column(batch.column(0))
            for start, stop in common.chunks(column):
                lines = split(column.slice(start, stop - start)).flatten()
                ids = line_ids(lines)
                _, at = np.unique(ids, return_index=True)
                at = at[(ids[at] != 0) & _has(shared.value, ids[at])]
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), lines.take(pa.array(at)).cast(pa.string())], names=["id", "line"])
        common.release()

    lines = texts.mapInArrow(run, "id long, line string").join(wanted, "id", "left_semi")
    return lines.groupBy("id").agg(F.first("line").alias("line"))


def grams(line: str) -> set[str]:
    return {line[i : i + GRAM] for i in range(max(1, len(line) - GRAM + 1))}


def verified(pairs: DataFrame, lines: DataFrame, numerator: int = NUMERATOR) -> DataFrame:
    """The pairs whose lines are similar enough, exactly."""
    left = pairs.join(lines.withColumnsRenamed({"id": "b", "line": "lb"}), "b")
    both = left.join(lines.withColumnsRenamed({"id": "a", "line": "la"}), "a").select("a", "b", "la", "lb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = similar(common.string_column(batch.column(2)), common.string_column(batch.column(3)), numerator)
            yield batch.select([0, 1]).filter(pa.array(good))
        common.release()

    return both.mapInArrow(run, "a long, b long")


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()


def deduplicate(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", numerator: int = NUMERATOR, scratch: Scratch | None = None
) -> DataFrame:
    """All columns of ``docs`` with the text's remaining lines, ``n_lines`` and ``n_kept``.

    Of each component of similar lines the first in the corpus stays, by document
    id (null ids last), then by the document's hash, then by line number. Lines of
    white space stay. Null texts stay null with 0 lines; an empty text is one blank
    line. Rows with the same id and text count as one document and are edited
    alike. Columns of the names of the new ones are replaced.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    texts = docs.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    found = scratch.cut(candidates(texts))
    members = found.where("band <> 0")
    heads = members.select("band", "b").distinct()
    lowest = heads.groupBy("band").agg(F.min("b").alias("a"))
    heads = heads.join(lowest, "band").select("a", "b")
    pairs = found.where("band = 0").select("a", "b").unionByName(heads).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = scratch.cut(pairs.distinct())
    lines = scratch.cut(_texts(texts, _ids(pairs)))
    links = scratch.cut(verified(pairs, lines, numerator))
    scratch.drop(lines)
    roots = components(links, scratch)
    rest = scratch.cut(unsettled(members, roots))
    if not rest.isEmpty():
        lines = scratch.cut(_texts(texts, rest.select("id").distinct()))
        more = scratch.cut(settled(rest.where(F.col("n") <= SMALL_BAND), lines, numerator))
        large = rest.where(F.col("n") > SMALL_BAND)
        if not large.isEmpty():
            roots = components(links.unionByName(more), scratch)
            now = large.drop("root").join(roots, F.col("id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "id"))
            more = more.unionByName(scratch.cut(verified(scratch.cut(remaining(now, lines, numerator)), lines, numerator)))
        scratch.drop(lines)
        if not more.isEmpty():
            roots = components(links.unionByName(more), scratch)
    for table in (found, pairs, rest):
        scratch.drop(table)
    # every occurrence of a line, without its text
    own = [c for c in docs.columns if c.lower() not in {"n_lines", "n_kept", "__key", "__ids", "__drops", "__edited"}]
    source = docs.select(*[F.col(f"`{c}`") for c in own]).withColumn("__key", F.xxhash64(F.col(f"`{id_column}`").cast("string"), F.col(f"`{text}`")))

    def ids_of():
        def run(texts: common.Texts) -> list:
            lines = split(texts.column)
            return [pa.ListArray.from_arrays(lines.offsets.cast(pa.int32()), pa.array(line_ids(lines.flatten())))]

        return run

    listed = common.with_text_columns(source, text, [("__ids", T.ArrayType(T.LongType()))], ids_of, [id_column, "__key"])
    places = listed.select(F.col(f"`{id_column}`").alias("doc"), F.col("__key").alias("key"), F.posexplode("__ids").alias("place", "id")).where("id <> 0")
    places = places.join(roots, F.col("id") == F.col("node"), "left").select("doc", "key", "place", F.coalesce("root", "id").alias("line"))
    places = scratch.cut(places)
    where = F.struct(F.col("doc").isNull().alias("none"), "doc", "key", "place")
    several = places.groupBy("line").agg(F.min(where).alias("first"), F.count("*").alias("n")).where("n > 1").select("line", "first")
    here = places.join(several, "line").where(~where.eqNullSafe(F.col("first")))
    drops = scratch.cut(here.groupBy(F.col("key").alias("__key")).agg(F.collect_set("place").alias("__drops")))
    scratch.drop(places)
    size = drops.agg(F.count("*").alias("documents"), F.sum(F.size("__drops")).alias("lines")).first()
    if size["documents"] <= MOST_EDITED and (size["lines"] or 0) <= MOST_DROPPED:
        drops = F.broadcast(drops)
    joined = source.join(drops, "__key", "left")
    whole = F.col(f"`{text}`").cast("string")
    n_lines = F.octet_length(whole) - F.octet_length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1
    kept = F.filter(F.split(whole, "\n", -1), lambda line, i: ~F.array_contains("__drops", i))
    # documents without repeats are not split, others once
    counted = joined.withColumns({"n_lines": F.coalesce(n_lines, F.lit(0)).cast("long"), "__edited": F.when(F.col("__drops").isNotNull() & whole.isNotNull(), kept)})
    changed = counted.withColumns({
        "n_kept": F.when(F.col("__edited").isNull(), F.col("n_lines")).otherwise(F.size("__edited")).cast("long"),
        "__edited": F.when(F.col("__edited").isNull(), F.col(f"`{text}`")).otherwise(F.array_join("__edited", "\n")),
    })
    return changed.select(*[F.col("__edited").alias(c) if c == text else F.col(f"`{c}`") for c in own], "n_lines", "n_kept")


def clean(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with edited texts; documents of which nothing but white space is left, and something was before, go."""
    apart, back = common.set_aside(docs, ["n_lines", "n_kept"])
    edited = deduplicate(apart, back.get(id_column, id_column), back.get(text, text), **options)
    lost = (F.col("n_kept") < F.col("n_lines")) & (F.trim(F.regexp_replace(F.col(f"`{back.get(text, text)}`"), r"\s", "")) == "")
    return common.restored(edited.where(~F.coalesce(lost, F.lit(False))), docs, back)
