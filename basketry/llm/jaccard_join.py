"""Self join of texts whose sets of word n-grams are similar, as classes of links.

Exact copies share one set and are handled once. All other pairs are found by the
prefix filter: in one order of all n-grams, two sets of Jaccard similarity t share
an n-gram among the first ``n - ceil(t n) + 1`` of each. The order puts n-grams that
many texts have last, so that shared passages seldom are in a prefix; it only
decides how much work there is, never which links are found.

Short index lists give pairs of sets, of which a count of the shared prefix
n-grams rules out most before sets are compared. Sets on long lists are near
copies of each other and are grouped by the lists they share. A group is cut into
blocks by size, and blocks whose sizes rule out a link do not meet. Where two meet,
set relations save work: the places of sets that are too small or too large are
skipped in every index list, and a set's answers are derived from the computed answers
of the set before that is most similar to it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm import common
from basketry.llm.components import components
from basketry.llm.storage import Scratch

WORDS = 5
#: The threshold as a ratio of whole numbers: intersection / union >= NUMERATOR / 100.
NUMERATOR = 75
#: From so many texts on, an n-gram is frequent. All tasks get a table of classes of frequency, of so many places (a
#: byte each) for each frequent n-gram and at most so many in all.
FREQUENT, PLACES, MOST_PLACES = 8, 4, 1 << 25
#: Lists of more sets than this are handled by groups.
LONG_LIST = 16
#: Sets in a block of a group.
BLOCK = 512
#: Needed sets whose ids are sent to all tasks (8 bytes each); with more, sets are selected by a join.
MOST_IDS = 1 << 21

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SEQUENCE = common.powers(0x2545F4914F6CDD1D, 64)


def shingles(texts: common.Texts, size: int = WORDS) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of its word n-grams.

    A text of fewer words has its whole sequence as one; one without words none.
    """
    data = common.LOWER[texts.bytes]
    starts, ends, index = common.word_spans(data, texts.offsets, _SPACE)
    words = common.word_hashes(data, starts, ends)
    grams = np.zeros(0, dtype=np.uint64)
    if len(words) >= size:
        grams = words[: len(words) - size + 1] * _SEQUENCE[0]
        for k in range(1, size):
            grams = grams + words[k : len(words) - size + 1 + k] * _SEQUENCE[k]
        grams = common.mix(grams)
    out = []
    for a, b in zip(index[:-1].tolist(), index[1:].tolist(), strict=True):
        if b - a >= size:
            g = np.sort(grams[a : b - size + 1])
            out.append(g[np.concatenate([[True], g[1:] != g[:-1]])])
        elif b > a:
            whole = (words[a:b] * _SEQUENCE[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(common.mix(np.array([whole], dtype=np.uint64)))
        else:
            out.append(grams[:0])
    return out


def set_id(grams: np.ndarray) -> int:
    """A hash of the set."""
    value = np.array([common.mix(grams).sum(dtype=np.uint64) + np.uint64(len(grams))], dtype=np.uint64)
    return int(common.mix(value).view(np.int64)[0])


def least_overlap(a: int, b: int, numerator: int = NUMERATOR) -> int:
    """The smallest intersection of linked sets of these sizes."""
    return -(-numerator * (a + b) // (100 + numerator))


def prefix_size(n: int, numerator: int = NUMERATOR) -> int:
    return n - -(-numerator * n // 100) + 1


class Order:
    """The order of n-grams: rare ones by hash, then frequent ones by class of their number of texts.

    ``classes`` has a byte for each range of hashes, a power of two of them; n-grams of one
    range have the class of the most frequent of them, so a few rare ones come later.
    """

    def __init__(self, classes: np.ndarray) -> None:
        self.classes, self.cut = classes, np.uint64(65 - len(classes).bit_length())

    def prefix(self, grams: np.ndarray, numerator: int) -> np.ndarray:
        size = prefix_size(len(grams), numerator)
        kind = self.classes[grams >> self.cut]
        if not kind.any():
            return grams[:size]
        return grams[np.argsort(kind, kind="stable")[:size]]  # they are sorted by hash


def frequency_class(counts: np.ndarray) -> np.ndarray:
    """1 at ``FREQUENT`` texts, 16 more where there are twice as many, at most 255."""
    return np.minimum(255, 1 + 16 * np.log2(np.maximum(counts, FREQUENT) / FREQUENT)).astype(np.uint8)


#: Leading bits of a hash that choose its range. A range is counted by one task in memory, 12 bytes for each of its
#: different n-grams; more bits make ranges smaller and packed values shorter.
RANGE_BITS = 12
#: N-grams that are gathered before they are counted together.
MERGE = 1 << 20


def frequent(docs: DataFrame, text: str, scratch: Scratch, words: int, bits: int = RANGE_BITS) -> DataFrame:
    """All n-grams that ``FREQUENT`` texts or more have, one row for each range of hashes (their first ``bits`` bits).

    ``grams`` packs the next 32 bits of their hashes and ``kinds`` their classes of frequency; ``n`` is their number.
    Tasks send their n-grams as packed 32-bit numbers, one binary value for each
    range of hashes and chunk of texts; every range is counted by itself.
    """
    cut = np.uint64(32 - bits)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = common.string_column(batch.column(0))
            for start, stop in common.chunks(column, 4 * common.CHUNK_BYTES):
                inner = column.slice(start, stop - start)
                sets = [s for a, b in common.chunks(inner) for s in shingles(common.Texts(inner.slice(a, b - a)), words)]
                grams = np.sort(np.concatenate(sets) >> cut)
                part = (grams >> np.uint64(32)).astype(np.int32)
                edge = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else part
                values = np.split(grams.astype(np.uint32), edge[1:]) if len(part) else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[edge] if len(part) else part, pa.int32()), pa.array([v.tobytes() for v in values], pa.binary())],
                    names=["range", "grams"],
                )
        common.release()

    def count(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        waiting, size = [], 0

        def merge() -> None:
            nonlocal grams, counts, size
            new, n = np.unique(np.concatenate([*waiting, np.zeros(0, np.uint32)]), return_counts=True)
            both, place = np.unique(np.concatenate([grams, new]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([counts, n]), len(both)).astype(np.int64)
            grams, size = both, 0
            waiting.clear()

        for batch in batches:
            for value in batch.column("grams"):
                waiting.append(np.frombuffer(value.as_buffer(), dtype=np.uint32))
                size += len(waiting[-1])
                if size > max(MERGE, len(grams)):
                    merge()
        merge()
        many = counts >= FREQUENT
        packed = [pa.array([x.tobytes()], pa.binary()) for x in (grams[many], frequency_class(counts[many]))]
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), *packed, pa.array([int(many.sum())])], names=["range", "grams", "kinds", "n"])

    packed = docs.select(F.col(f"`{text}`").cast("string")).mapInArrow(pack, "range int, grams binary")
    return scratch.cut(packed.groupBy("range").applyInArrow(count, "range int, grams binary, kinds binary, n long"))


def _order(table: DataFrame, bits: int = RANGE_BITS) -> Order:
    """The order of the n-grams of ``frequent``; each row fills its own places of the table."""
    number = table.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    inner = max(4, min(PLACES * number, MOST_PLACES).bit_length() - 1 - bits)  # bits of a place inside of a range

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            filled = []
            for grams, kinds in zip(batch.column("grams"), batch.column("kinds"), strict=True):
                places = np.zeros(1 << inner, dtype=np.uint8)
                at = np.frombuffer(grams.as_buffer(), dtype=np.uint32) >> np.uint32(32 - inner)
                np.maximum.at(places, at, np.frombuffer(kinds.as_buffer(), dtype=np.uint8))
                filled.append(places.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("range"), pa.array(filled, pa.binary())], names=["range", "places"])

    classes = np.zeros((1 << bits, 1 << inner), dtype=np.uint8)
    rows = table.where("n > 0").select("range", "grams", "kinds").mapInArrow(fill, "range int, places binary").toArrow()  # MOST_PLACES bytes at most
    for where, places in zip(rows["range"].to_pylist(), rows["places"], strict=True):
        classes[where] = np.frombuffer(places.as_buffer(), dtype=np.uint8)
    return Order(classes.ravel())


def describe(docs: DataFrame, text: str, order: Order, keep: list[str], words: int, numerator: int) -> DataFrame:
    """Adds ``n_shingles``, ``set_id`` and ``prefix``; the prefix is null for all but the first copy in a chunk."""
    shared = docs.sparkSession.sparkContext.broadcast(order)  # MOST_PLACES bytes at most

    def make():
        def run(texts: common.Texts) -> list:
            sets = shingles(texts, words)
            ids = [set_id(s) if len(s) else None for s in sets]
            seen: set[int | None] = {None}
            prefixes = []
            for s, i in zip(sets, ids, strict=True):
                prefixes.append(None if i in seen else shared.value.prefix(s, numerator).view(np.int64))
                seen.add(i)
            return [[len(s) for s in sets], ids, prefixes]

        return run

    fields = [("n_shingles", T.LongType()), ("set_id", T.LongType()), ("prefix", T.ArrayType(T.LongType()))]
    return common.with_text_columns(docs, text, fields, make, keep)


def select_sets(docs: DataFrame, text: str, wanted: DataFrame, words: int) -> DataFrame:
    """``id``, ``grams`` (packed sorted hashes) of the sets whose ids are in ``wanted``, one row each."""
    spark = docs.sparkSession
    few = wanted.count() <= MOST_IDS
    ids = np.sort(np.array([r[0] for r in wanted.toLocalIterator()], dtype=np.int64)) if few else None
    shared = spark.sparkContext.broadcast(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            column = common.string_column(batch.column(0))
            for start, stop in common.chunks(column):
                out = {}
                for s in shingles(common.Texts(column.slice(start, stop - start)), words):
                    if len(s):
                        i = set_id(s)
                        if i not in out and (known is None or (len(known) and known[min(np.searchsorted(known, i), len(known) - 1)] == i)):
                            out[i] = s.tobytes()
                yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64()), pa.array(list(out.values()), pa.binary())], names=["id", "grams"])
        common.release()

    sets = docs.select(F.col(f"`{text}`").cast("string")).mapInArrow(run, "id long, grams binary")
    if not few:
        sets = sets.join(wanted, "id", "left_semi")
    return sets.groupBy("id").agg(F.first("grams").alias("grams"))


def _linked(common_grams: int, a: int, b: int, numerator: int) -> bool:
    return 100 * common_grams >= numerator * (a + b - common_grams)


def _grams(value) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), dtype=np.uint64)


def verified(pairs: DataFrame, sets: DataFrame, numerator: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose sets are linked."""
    left = pairs.join(sets.withColumnsRenamed({"id": "b", "grams": "gb"}), "b")
    both = left.join(sets.withColumnsRenamed({"id": "a", "grams": "ga"}), "a").select("a", "b", "ga", "gb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = _grams(x), _grams(y)
                n = len(np.intersect1d(x, y, assume_unique=True))
                good.append(_linked(n, len(x), len(y), numerator))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))
        common.release()

    return both.mapInArrow(run, "a long, b long")


def block_links(
    ids: list[int], sets: list[np.ndarray], sides: list[int], numerator: int, reads: list[int] | None = None
) -> list[tuple[int, int]]:
    """Links that connect all linked sets of a block, or of the sides 0 and 1 of two blocks.

    Sets are taken by size and an n-gram's index list has its sets in that order, so
    the sizes that a link allows are a range of places in every list; the rest of it
    is skipped. All overlaps in that range are a set's answers. They are derived from
    those of the set before with which it has most n-grams in common, if that is close:
    only lists of n-grams that one of the two has and the other has not are read.
    ``reads`` gets the number of list entries read for each set.
    """
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), ids[i]))
    sets, ids, side = [sets[i] for i in order], [ids[i] for i in order], np.array([sides[i] for i in order])
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    _, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    entry = np.sort(inverse.astype(np.int64) * n + owner)  # all lists one after another
    tokens = np.split(inverse.astype(np.int64), np.cumsum(sizes)[:-1])
    low = np.searchsorted(sizes, -(-numerator * sizes // 100), side="left")
    high = np.searchsorted(sizes, 100 * sizes // numerator, side="right")
    two = len(set(sides)) > 1
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    read = 0

    def counted(which: np.ndarray, start: int, stop: int) -> np.ndarray:
        """How many of the lists ``which`` have each set of the places ``start`` to ``stop``."""
        nonlocal read
        first = np.searchsorted(entry, which * n + start)
        size = np.searchsorted(entry, which * n + stop) - first
        at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        read += len(at)
        return np.bincount(entry[at] % n - start, minlength=stop - start)

    overlap = np.zeros((n, n), dtype=np.int32)
    base, common_grams = np.full(n, -1), np.zeros(n, dtype=np.int64)
    links = []
    for x in range(n):
        a, z, mine, near = int(low[x]), int(high[x]), tokens[x], int(base[x])
        start, stop = a, a  # places whose answers are derived
        if near >= 0 and 2 * (sizes[near] + sizes[x] - 2 * common_grams[x]) < sizes[x]:
            start, stop = max(a, int(low[near])), min(z, int(high[near]))
        if start < stop:
            gone, come = np.setdiff1d(tokens[near], mine, assume_unique=True), np.setdiff1d(mine, tokens[near], assume_unique=True)
            overlap[x, start:stop] = overlap[near, start:stop] - counted(gone, start, stop) + counted(come, start, stop)
        else:
            start = stop = a
        for p, q in ((a, start), (stop, z)):
            if p < q:
                overlap[x, p:q] = counted(mine, p, q)
        row = overlap[x, a:z]
        closer = row > common_grams[a:z]
        base[a:z][closer], common_grams[a:z] = x, np.maximum(common_grams[a:z], row)
        before = row[: x - a]
        found = np.flatnonzero(100 * before >= numerator * (sizes[a:x] + sizes[x] - before)) + a
        if two:
            found = found[side[found] != side[x]]
        for y in found.tolist():
            rx, ry = root(x), root(y)
            if rx != ry:
                parent[max(rx, ry)] = min(rx, ry)
                links.append((ids[x], ids[y]))
        if reads is not None:
            reads.append(read)
            read = 0
    return links


def group_links(members: DataFrame, sets: DataFrame, numerator: int) -> DataFrame:
    """Links inside groups: ``members`` has ``group``, ``id``, ``n``.

    Sets of a group are dealt by size class and hash into blocks of about ``BLOCK``.
    Every block meets itself, the blocks of its class after it and those of the next
    class; a set is at most 100 / numerator times as large as one it is linked to.
    """
    ratio = math.log(100 / numerator)
    kind = F.floor(F.log(F.col("n").cast("double")) / ratio + 1e-9).cast("int")
    m = members.withColumn("kind", kind)
    number = m.groupBy("group", "kind").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    after = number.select("group", (F.col("kind") - 1).alias("kind"), F.col("blocks").alias("blocks_after"))
    before = number.select("group", (F.col("kind") + 1).alias("kind"), F.col("blocks").alias("blocks_before"))
    dealt = number.join(after, ["group", "kind"], "left").join(before, ["group", "kind"], "left")
    m = m.join(dealt, ["group", "kind"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    upto = lambda low, high: F.when(high >= low, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    cell = lambda k1, b1, k2, b2, s: F.struct(k1.alias("k1"), b1.alias("b1"), k2.alias("k2"), b2.alias("b2"), F.lit(s).alias("side"))
    k, b, zero = F.col("kind"), F.col("block"), F.lit(0)
    cells = F.concat(
        F.transform(upto(b, F.col("blocks") - 1), lambda j: cell(k, b, k, j, 0)),
        F.transform(upto(zero, b - 1), lambda i: cell(k, i, k, b, 1)),
        F.when(F.col("blocks_after").isNotNull(), F.transform(upto(zero, F.col("blocks_after") - 1), lambda j: cell(k, b, k + 1, j, 0))).otherwise(F.array()),
        F.when(F.col("blocks_before").isNotNull(), F.transform(upto(zero, F.col("blocks_before") - 1), lambda i: cell(k - 1, i, k, b, 1))).otherwise(F.array()),
    )
    spread = m.select("group", "id", F.explode(cells).alias("c")).select("group", "id", "c.*").join(sets, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches).combine_chunks()
        grams = [_grams(v) for v in table["grams"]]
        links = block_links(table["id"].to_pylist(), grams, table["side"].to_pylist(), numerator)
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], names=["a", "b"])

    return spread.groupBy("group", "k1", "b1", "k2", "b2").applyInArrow(run, "a long, b long")


def classes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    numerator: int = NUMERATOR,
    keep: list[str] | None = None,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Columns ``keep`` (default: the id), ``n_shingles``, ``component_id`` and ``class_id``.

    ``component_id`` is the smallest id that links reach; null ids are never
    smallest, so it is null only where all reached ids are. ``class_id`` is the same
    for all linked texts, whatever their ids. A text without words is linked with
    nothing: its component is its own id and its class null. Repeated rows are
    copies. N-grams and sets are known by 64-bit hashes.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    kept = [c for c in dict.fromkeys([id_column, *(keep or [])]) if c.lower() not in {"n_shingles", "component_id", "class_id", "set_id", "prefix"}]
    counted = frequent(docs, text, scratch, words)
    order = _order(counted)
    scratch.drop(counted)
    described = scratch.cut(describe(docs, text, order, kept, words, numerator))
    # index lists of more than one set
    entries = described.where("prefix is not null").select("set_id", "n_shingles", F.explode("prefix").alias("gram"))
    several = entries.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    shared = scratch.cut(entries.join(several, "gram").select("gram", F.col("set_id").alias("id"), F.col("n_shingles").alias("n")).distinct())
    lengths = shared.groupBy("gram").agg(F.count("*").alias("length")).where("length > 1")
    posts = scratch.cut(shared.join(lengths, "gram").withColumn("long", F.col("length") > LONG_LIST).drop("length"))
    scratch.drop(shared)
    # pairs from short lists
    held = posts.where("long").groupBy("id").agg(F.count("*").alias("held"))
    short = posts.where("not long").join(held, "id", "left").select("gram", "id", "n", F.coalesce("held", F.lit(0)).alias("h"))
    other = short.select("gram", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("h").alias("hb"))
    met = short.withColumnsRenamed({"id": "a", "n": "na", "h": "ha"}).join(other, "gram").where(
        (F.col("a") < F.col("b")) & (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * numerator)
    )
    pairs = met.groupBy("a", "b").agg(F.count("*").alias("shared"), F.first("na").alias("na"), F.first("nb").alias("nb"), F.min(F.least("ha", "hb")).alias("held"))
    rest = F.ceil(F.greatest("na", "nb") * numerator / 100) - 1  # behind the prefix
    need = F.ceil((F.col("na") + F.col("nb")) * numerator / (100 + numerator) - 1e-9)
    pairs = scratch.cut(pairs.where(F.col("shared") + F.col("held") + rest >= need).select("a", "b"))
    # groups from long lists
    long = posts.where("long")
    hubs = long.groupBy("gram").agg(F.min("id").alias("hub"))
    joined = components(long.join(hubs, "gram").select(F.col("hub").alias("a"), F.col("id").alias("b")), scratch)
    sizes = long.select("id", "n").distinct()
    members = scratch.cut(joined.join(sizes, F.col("node") == F.col("id")).select(F.col("root").alias("group"), "id", "n"))
    scratch.drop(posts)
    # compare
    wanted = scratch.cut(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(members.select("id")).distinct())
    sets = scratch.cut(select_sets(docs, text, wanted, words))
    links = scratch.cut(verified(pairs, sets, numerator).union(group_links(members, sets, numerator)))
    for table in (pairs, members, wanted, sets):
        scratch.drop(table)
    roots = components(links, scratch)
    least = described.where("set_id is not null").groupBy("set_id").agg(F.min(id_column).alias("__least"))
    classes_ = least.join(roots, F.col("set_id") == F.col("node"), "left").select("set_id", F.coalesce("root", "set_id").alias("__root"), "__least")
    best = classes_.groupBy("__root").agg(F.min("__least").alias("__first"))
    named = classes_.join(best, "__root").select(F.col("set_id").alias("__set"), "__root", "__first")
    out = described.join(named, F.col("set_id") == F.col("__set"), "left")
    component = F.when(F.col("set_id").isNull(), F.col(f"`{id_column}`")).otherwise(F.col("__first"))
    return out.select(*[F.col(f"`{c}`") for c in kept], "n_shingles", component.alias("component_id"), F.col("__root").alias("class_id"))


def first_of_class(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each class of linked texts, with its own columns: the one of the smallest id.

    Null ids come last, ties are broken by a hash of id and text. Of rows with the
    same id and text one stays. Texts without words all stay.
    """
    key = F.xxhash64(F.col(f"`{id_column}`").cast("string"), F.col(f"`{text}`"))
    own = docs.columns
    keyed = docs.withColumn("__key", key)
    worded = F.coalesce(F.col(f"`{text}`"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    narrow = keyed.select(F.col(f"`{id_column}`").alias("__id"), F.col(f"`{text}`").alias("__text"), "__key")
    found = classes(narrow, "__id", "__text", keep=["__key"], **options).where("class_id is not null")
    first = found.groupBy("class_id").agg(F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__key")).alias("f")).select(F.col("f.__key").alias("__key"))
    chosen = keyed.where(worded).join(first, "__key", "left_semi").dropDuplicates(["__key"])
    return chosen.unionByName(keyed.where(~worded)).select(*[F.col(f"`{c}`") for c in own])
