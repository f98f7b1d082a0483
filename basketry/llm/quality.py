"""Quality: gradient-boosted trees over document statistics.

Every whole text gives a row of statistics, counted on the bytes of many texts at
once. Statistics are put into at most ``BINS`` quantile bins; trees are grown on
the gradients' histograms and flattened into arrays, so that all rows of a batch
step down all trees together. The model is fitted on the driver on at most
``SAMPLE_ROWS`` labelled rows, taken in the order of a hash of their ids.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm import common

#: Bound of the training sample.
SAMPLE_ROWS = 20_000
BINS = 64
THRESHOLD = 0.5

STATISTICS = (
    "log_bytes", "log_words", "log_lines", "word_bytes", "word_spread", "long_words", "short_words",
    "upper", "digits", "signs", "bars", "marks", "brackets", "hash_like", "blank", "not_ascii", "capitalised",
    "all_upper", "ends_with_sign", "distinct_words", "repeated_words", "distinct_pairs", "top_word",
    "line_bytes", "distinct_lines", "lines_ended", "short_lines", "sentence_words",
)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars.encode())] = True
    return out


_UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _class("0123456789")
_MARK = _class(".,;:!?")
_STOP = _class(".!?")
_BRACKET = _class("()[]{}<>")
_HASHLIKE = _class("#$%&*@^~+=")
_SIGN = _class("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
_CLASSES = np.stack(
    [_UPPER, _DIGIT, _SIGN, _class("|"), _MARK, _BRACKET, _HASHLIKE, _SPACE, _STOP, np.arange(256) >= 0x80]
).astype(float)


def _distinct(keys: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each owner, the number of different keys and the count of the most common one."""
    if not len(keys):
        return np.zeros(n), np.zeros(n)
    both = common.mix(keys + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(both)
    k, o = both[order], owner[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = k[1:] != k[:-1]
    at = np.flatnonzero(new)
    runs = np.diff(np.concatenate([at, [len(k)]]))
    most = np.zeros(n)
    np.maximum.at(most, o[at], runs)
    return np.bincount(o[at], minlength=n).astype(float), most


def statistics(texts: common.Texts) -> np.ndarray:
    """One row of ``STATISTICS`` for each text; zeros for an empty one."""
    n = len(texts)
    data, offsets = texts.bytes, texts.offsets
    size = np.diff(offsets).astype(float)
    out = np.zeros((n, len(STATISTICS)))
    if not len(data):
        return out
    place = np.repeat(np.arange(n, dtype=np.int64) << 8, np.diff(offsets)) + data
    seen = np.bincount(place, minlength=n << 8).reshape(n, 256).astype(float)  # bytes by text and value
    upper, digit, sign, bar, mark, bracket, hashlike, space, stop, high = (seen @ _CLASSES.T).T
    starts, ends, index = common.word_spans(data, offsets, _SPACE)
    words = np.diff(index).astype(float)
    owner = np.repeat(np.arange(n), np.diff(index))
    length = (ends - starts).astype(float)
    word_sum = lambda v: np.bincount(owner, v, n) if len(owner) else np.zeros(n)
    w, s = np.maximum(words, 1), np.maximum(size, 1)
    mean = word_sum(length) / w
    key = common.word_hashes(data, starts, ends)
    same = np.zeros(len(key))
    same[1:] = (key[1:] == key[:-1]) & (owner[1:] == owner[:-1])
    pair = common.mix(key[:-1] + key[1:] * np.uint64(31)) if len(key) else key
    paired = owner[:-1][owner[1:] == owner[:-1]]
    n_distinct, top = _distinct(key, owner, n)
    n_pairs, _ = _distinct(pair[owner[1:] == owner[:-1]], paired, n)
    uppers = np.concatenate([[0], np.cumsum(_UPPER[data], dtype=np.int32)])
    signs = np.concatenate([[0], np.cumsum(_SIGN[data], dtype=np.int32)])
    in_upper = (uppers[ends] - uppers[starts]).astype(float)
    in_signs = (signs[ends] - signs[starts]).astype(float)
    last = data[ends - 1] if len(ends) else data[:0]
    newline = np.zeros(256, dtype=bool)
    newline[10] = True
    l_starts, l_ends, l_index = common.word_spans(data, offsets, newline)
    lines = np.diff(l_index).astype(float)
    l_owner = np.repeat(np.arange(n), np.diff(l_index))
    l_size = (l_ends - l_starts).astype(float)
    line_sum = lambda v: np.bincount(l_owner, v, n) if len(l_owner) else np.zeros(n)
    l_distinct, _ = _distinct(common.word_hashes(data, l_starts, l_ends), l_owner, n)
    ln = np.maximum(lines, 1)
    values = (
        np.log1p(size), np.log1p(words), np.log1p(lines), mean,
        np.sqrt(np.maximum(word_sum(length**2) / w - mean**2, 0)), word_sum(length > 15) / w, word_sum(length < 3) / w,
        upper / s, digit / s, sign / s, bar / w, mark / w, bracket / w, hashlike / w, space / s, high / s,
        word_sum(_UPPER[data[starts]] if len(starts) else length) / w,
        word_sum((in_upper > 1) & (in_upper + in_signs >= 0.99 * length)) / w,
        word_sum(_SIGN[last]) / w, n_distinct / w, word_sum(same) / w, n_pairs / w, top / w,
        line_sum(l_size) / ln, l_distinct / ln, line_sum(_STOP[data[l_ends - 1]] if len(l_ends) else l_size) / ln,
        line_sum(l_size < 30) / ln, words / np.maximum(stop, 1),
    )
    for i, v in enumerate(values):
        out[:, i] = v
    return out


@dataclass
class Forest:
    """Trees as arrays: every node's statistic, bin, left child (right: one more) and value.

    A leaf is its own left child with statistic 0 and a bin that everything is in.
    """

    edges: list[np.ndarray]
    roots: np.ndarray
    column: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    value: np.ndarray
    depth: int
    start: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        binned = binned_rows(rows, self.edges)
        at = np.broadcast_to(self.roots, (len(rows), len(self.roots))).copy()
        row = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            at = self.left[at] + (binned[row, self.column[at]] > self.bin[at])
        total = self.start + self.value[at].sum(1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def binned_rows(rows: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, rows[:, i], side="left") for i, e in enumerate(edges)], 1).astype(np.int16)


def fit(rows: np.ndarray, labels: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, least: float = 3.0) -> Forest:
    """Boost logistic loss; the same data give the same trees."""
    share = float(np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99))
    start = float(np.log(share / (1 - share)))
    columns = len(STATISTICS)
    edges = [np.unique(np.quantile(rows[:, i], np.linspace(0, 1, BINS + 1)[1:-1])) if len(rows) else np.zeros(0) for i in range(columns)]
    if not len(rows) or len(set(labels.tolist())) < 2:
        one = np.zeros(1, dtype=np.int64)
        return Forest(edges, one, one, one + BINS, one, np.zeros(1), 0, start)
    binned = binned_rows(rows, edges)
    flat = binned + np.arange(columns) * BINS
    total = np.full(len(rows), start)
    column, cut, left, value, roots = [], [], [], [], []

    def node() -> int:
        column.append(0)
        cut.append(BINS)
        left.append(len(left))
        value.append(0.0)
        return len(left) - 1

    def histogram(members: np.ndarray, v: np.ndarray) -> np.ndarray:
        return np.bincount(flat[members].ravel(), np.repeat(v[members], columns), columns * BINS).reshape(columns, BINS)

    def grow(at: int, members: np.ndarray, level: int) -> None:
        g, h = gradient[members].sum(), curve[members].sum()
        value[at] = -rate * g / (h + 1.0)
        if level == depth or len(members) < 2:
            return
        gl, hl = np.cumsum(histogram(members, gradient), 1), np.cumsum(histogram(members, curve), 1)
        gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
        gain[(hl < least) | (h - hl < least)] = 0
        best = int(gain.argmax())
        if gain.flat[best] <= 1e-6:
            return
        c, b = divmod(best, BINS)
        low = binned[members, c] <= b
        one, two = node(), node()
        column[at], cut[at], left[at] = c, b, one
        grow(one, members[low], level + 1)
        grow(two, members[~low], level + 1)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        gradient, curve = p - labels, p * (1 - p)
        root = node()
        roots.append(root)
        grow(root, np.arange(len(rows)), 0)
        c, b, l, v = map(np.array, (column[root:], cut[root:], left[root:], value[root:]))
        at = np.zeros(len(rows), dtype=np.int64)
        for _ in range(depth):
            at = l[at] - root + (binned[np.arange(len(rows)), c[at]] > b[at])
        total += v[at]
    return Forest(edges, np.array(roots), np.array(column), np.array(cut), np.array(left), np.array(value), depth, start)


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality") -> Forest:
    """Fit on the sample; ``labels`` holds the rows that may teach.

    Null ids and labels are left out. If rows of one id disagree, the smallest
    label counts; of several documents of an id the one of the smallest statistics
    teaches. Without two classes, every score is the share of the class.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(id_column).isNotNull())
    chosen = (
        known.groupBy(F.col(id_column).alias("__id"))
        .agg(F.min(label).cast("int").alias("__label"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(SAMPLE_ROWS)
    )
    sample = docs.join(F.broadcast(chosen), F.col(id_column) == F.col("__id")).select("__id", "__label", text)
    fields = [("__row", T.ArrayType(T.DoubleType()))]
    made = common.with_text_columns(sample, text, fields, lambda: lambda t: [list(statistics(t))], ["__id", "__label"])
    one = made.groupBy("__id").agg(F.min("__label").alias("__label"), F.min("__row").alias("__row"))
    rows = sorted(one.collect(), key=lambda r: r["__id"])  # a few numbers for SAMPLE_ROWS rows
    return fit(np.array([r["__row"] for r in rows]).reshape(-1, len(STATISTICS)), np.array([r["__label"] for r in rows], dtype=np.int64))


def score(df: DataFrame, forest: Forest, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``quality_score`` (double, 0 to 1). Null and empty texts are scored by their statistics, all 0."""
    shared = df.sparkSession.sparkContext.broadcast(forest)  # at most 80 trees of 31 nodes

    def make():
        return lambda texts: [shared.value.scores(statistics(texts))]

    return common.with_text_columns(df, text, [("quality_score", T.DoubleType())], make, keep)
