"""Spelling variants: the vocabulary of a corpus, grouped by edits of one letter.

Words one edit apart agree outside a segment of ``SEGMENT`` letters, counted on the
shorter one. Every word is dealt to a block for each segment by the hash of what is
outside, so two near words share a block. A block has a bit-sliced position index:
for each (position, letter) the set of its words as a long number of bits. The
letters of a word drive recurrences over whole sets: those without an error so far,
and those with one letter replaced, one more (all later positions shifted by one)
or one less. Words that share a beginning share these sets.

A block holds what it was dealt in memory: some ``BLOCK`` words, and never more than
the words of one segment's group, which can differ in two or three letters only.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import common
from basketry.llm.storage import Scratch

#: Runs of letters; only A-Z are lower-cased.
RUN = re.compile("[a-zÀ-ÿ]+")
#: A run whose hash is divisible by this loses a letter.
LOSS = 97
#: Least letters and occurrences of a word.
LETTERS, OCCURRENCES = 5, 3
#: Letters in a segment; words dealt to a block, on average.
SEGMENT, BLOCK = 2, 8192
#: Different words that a task counts before it sends them on.
HELD = 1 << 18


def runs(doc_id: str, text: str, loss: int = LOSS) -> list[str]:
    """The words of a text, some of them with a letter lost, as a hash of id and word decides."""
    words = RUN.findall(text.encode("utf-8").lower().decode("utf-8"))  # bytes: A-Z only
    start = zlib.crc32(f"{doc_id}:".encode())
    hashes = np.array([zlib.crc32(w.encode(), start) for w in words], dtype=np.int64)
    for i in np.flatnonzero(hashes % loss == 0).tolist():
        at = int(hashes[i]) % len(words[i])
        words[i] = words[i][:at] + words[i][at + 1 :]
    return words


def vocabulary(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", letters: int = LETTERS, occurrences: int = OCCURRENCES
) -> DataFrame:
    """``word``, ``n``: words of enough letters that occur often enough in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            kept = [(w, n) for w, n in counts.items() if len(w) >= letters]
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])

        for batch in batches:
            texts = common.string_column(batch.column(1))
            for start, stop in common.chunks(texts):
                for i, t in zip(batch.column(0).slice(start, stop - start).to_pylist(), texts.slice(start, stop - start).to_pylist(), strict=True):
                    counts.update(runs(i or "", t or ""))
                if len(counts) > HELD:
                    yield flush()
        yield flush()
        common.release()

    parts = docs.select(F.col(f"`{id_column}`").cast("string"), F.col(f"`{text}`").cast("string")).mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


def outside(word: str, base: int, segment: int) -> bytes:
    """What a word, seen as one of ``base`` letters with one more or none, has outside a segment."""
    after = max(0, base - (segment + 1) * SEGMENT)
    return f"{base},{segment},{word[: segment * SEGMENT]},{word[len(word) - after :]}".encode()


def blocks_of(word: str, number: int, letters: int = LETTERS) -> set[int]:
    """The blocks of a word: as the shorter or equal one of a pair, and as the longer one."""
    size = len(word)
    return {zlib.crc32(outside(word, base, s)) % number for base in (size, size - 1) if base >= letters for s in range(-(-base // SEGMENT))}


def meeting_block(a: str, b: str, number: int) -> int:
    """The one block, of those that two near words share, that reports them: by the first letter that differs."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    at = len(os.path.commonprefix([short, long]))
    segment = min(at // SEGMENT, -(-len(short) // SEGMENT) - 1)
    return zlib.crc32(outside(short, len(short), segment)) % number


class PositionIndex:
    """Sets of words, as bits of a number, by (position, letter) and by length."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        first = np.cumsum(sizes) - sizes
        as_bits = lambda chosen: int.from_bytes(np.packbits(chosen, bitorder="little").tobytes(), "little")
        self.all = as_bits(np.ones(len(words), dtype=bool))
        self.sized = {int(n): as_bits(sizes == n) for n in np.unique(sizes)}
        self.at: list[dict[str, int]] = []
        for p in range(int(sizes.max(initial=0))):
            here = np.zeros(len(words), dtype=np.uint32)
            long = sizes > p
            here[long] = points[first[long] + p]
            self.at.append({chr(c): as_bits(here == c) for c in np.unique(here[long])})
        self.states = [(self.all, 0, self.all, 0)]  # after no letter: any word, and any after one more letter
        self.seen = ""

    def with_letter(self, position: int, letter: str) -> int:
        return self.at[position].get(letter, 0) if 0 <= position < len(self.at) else 0

    def near(self, word: str) -> int:
        """Set of the words one edit from ``word``; quickest if words are asked in order."""
        shared = len(os.path.commonprefix([word, self.seen]))
        del self.states[shared + 1 :]
        self.seen = word
        for i in range(shared + 1, len(word) + 1):
            letter = word[i - 1]
            zero, replaced, more, less = self.states[-1]
            here = self.with_letter(i - 1, letter)
            next_zero = zero & here
            self.states.append(
                (
                    next_zero,
                    (replaced & here) | (zero & ~here),
                    (more & self.with_letter(i, letter)) | next_zero,
                    ((less & self.with_letter(i - 2, letter)) if i > 1 else 0) | zero,
                )
            )
        _, replaced, more, less = self.states[-1]
        size, none = len(word), 0
        return (replaced & self.sized.get(size, none)) | (more & self.sized.get(size + 1, none)) | (less & self.sized.get(size - 1, none))

    def members(self, chosen: int) -> Iterator[int]:
        while chosen:
            lowest = chosen & -chosen
            yield lowest.bit_length() - 1
            chosen ^= lowest


def nearest(words: DataFrame, letters: int = LETTERS, block: int = BLOCK) -> DataFrame:
    """``word``, ``n_near``, ``form``, ``form_n`` of every row of ``words`` (``word``, ``n``) that has near words.

    ``form`` is the near word of largest ``n``, the first of them in code-point order.
    """
    dealt = words.agg(F.sum(F.length("word"))).first()[0] or 0
    number = max(1, -(-dealt // block))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            to, rows = [], []
            for row, word in enumerate(batch.column(0).to_pylist()):
                for b in blocks_of(word, number, letters):
                    to.append(b)
                    rows.append(row)
            chosen = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), *chosen.columns], names=["block", "word", "n"])

    def compare(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = key[0].as_py()
        table = pa.Table.from_batches(batches).sort_by("word")
        vocabulary, n = table["word"].to_pylist(), table["n"].to_pylist()
        index = PositionIndex(vocabulary)
        found = []
        for word in vocabulary:
            near = [v for v in index.members(index.near(word)) if meeting_block(word, vocabulary[v], number) == here]
            if near:
                best = max(near, key=lambda v: (n[v], -v))  # words are sorted
                found.append((word, len(near), vocabulary[best], n[best]))
        columns = list(zip(*found, strict=True)) or [[], [], [], []]
        types = [pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["word", "n_near", "form", "form_n"])

    blocks = words.select("word", "n").mapInArrow(deal, "block long, word string, n long")
    partial = blocks.groupBy("block").applyInArrow(compare, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    whole = partial.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return whole.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word``, ``root``: the last word that forms lead to, by pointer jumping; chains halve in a round.

    A form occurs at least twice as often as its word, so chains end.
    """
    now = scratch.cut(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while not now.where("moved").isEmpty():
        above = now.select(F.col("word").alias("root"), F.col("root").alias("top"))
        now = scratch.cut(now.join(above, "root", "left").select("word", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")))
    return now.select("word", "root")


def variants(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    letters: int = LETTERS,
    occurrences: int = OCCURRENCES,
    scratch: Scratch | None = None,
) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root`` of every word of the vocabulary.

    ``n_near`` counts the words that one inserted, deleted or replaced letter away;
    ``form`` is the one of largest ``n`` (ties: smallest in code-point order) if that
    is at least twice the word's own, else null; ``root`` is where forms lead to, the
    word itself without one. Null texts have no words and a null id is hashed as an
    empty one. Repeated rows count each. Other columns are not looked at. An empty
    table has no words.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    words = scratch.cut(vocabulary(docs, id_column, text, letters, occurrences))
    near = scratch.cut(nearest(words, letters))
    joined = scratch.cut(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            *[F.when(F.col("form_n") >= 2 * F.col("n"), F.col(c)).alias(c) for c in ("form", "form_n")],
        )
    )
    last = roots(joined.where("form is not null"), scratch)
    return joined.join(last, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
