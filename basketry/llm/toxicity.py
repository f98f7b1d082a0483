"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A text's bag holds its words and their character n-grams (over UTF-8 bytes, word
ends marked by blanks), hashed into buckets. The embeddings of a window of words
are averaged and put through a linear softmax; embeddings and softmax are trained
together in numpy. Misspelt or inflected words share n-grams with known ones and
so share their vectors. A text is as toxic as its most toxic window, so that a
few words in a long text are not averaged away. In training a toxic text teaches
through its most toxic windows only, a clean one through all.

The model is fitted on the driver on a bounded sample: at most ``SAMPLE_ROWS``
labelled rows, one document each, drawn by label in the order of a hash of their
ids. Their texts are read whole. Probabilities are calibrated on texts that the model
has not seen, scored as any other, and weighted by the labels' shares.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm import common

#: Bound of the training sample.
SAMPLE_ROWS = 2500
#: Words in a window; windows of a scored text overlap by half.
WINDOW = 24
GRAMS = (3, 4, 5)
BUCKET_BITS = 16
SIZE = 8
THRESHOLD = 0.3
#: A bag of fewer features is filled up with zero vectors, so that one odd word alone is no evidence.
LEAST = 100

#: Letters, digits and all bytes that are not ASCII belong to words; A-Z become a-z.
_NORMAL = np.full(256, 0x20, dtype=np.uint8)
_NORMAL[0x30:0x3A] = np.arange(0x30, 0x3A)
_NORMAL[0x61:0x7B] = np.arange(0x61, 0x7B)
_NORMAL[0x41:0x5B] = np.arange(0x61, 0x7B)
_NORMAL[0x80:] = np.arange(0x80, 0x100)
_EDGE = 0xFF
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def normalise(texts: list[bytes]) -> np.ndarray:
    """Each text as `` w1 w2 .. wn `` followed by an edge byte.

    A word that repeats the one before it is left out, so that no single word
    fills a window.
    """
    plain = _NORMAL[np.frombuffer(b" " + b" \xff ".join(texts) + b" \xff ", dtype=np.uint8)]
    blank = plain == 0x20
    again = np.zeros(len(plain), dtype=bool)
    again[1:] = blank[1:] & blank[:-1]
    norm = plain[~again]
    blanks = np.flatnonzero(norm == 0x20)
    words = common.word_hashes(norm, blanks[:-1] + 1, blanks[1:])
    same = np.flatnonzero((words[1:] == words[:-1]) & (norm[blanks[1:-1] + 1] != _EDGE)) + 1
    change = np.zeros(len(norm) + 1, dtype=np.int8)
    change[blanks[same]] += 1
    change[blanks[same + 1]] -= 1
    return norm[np.cumsum(change[:-1], dtype=np.int8) == 0]


def _bucket(value: np.ndarray) -> np.ndarray:
    return ((value * _MULTIPLIER) >> np.uint64(64 - BUCKET_BITS)).astype(np.uint16)


def features(norm: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions in a normalised text and the buckets of the n-grams or words there."""
    blank = (norm == 0x20) | (norm == _EDGE)
    n = len(norm)
    wide = norm.astype(np.uint64)
    value = wide.copy()
    for length in range(2, min(max(GRAMS), n) + 1):
        value = value[: n - length + 1] | (wide[length - 1 :] << np.uint64(8 * (length - 1)))
        if length in GRAMS:
            inner = np.zeros(n - length + 1, dtype=bool)
            for k in range(1, length - 1):
                inner |= blank[k : n - length + 1 + k]
            edge = (norm[: n - length + 1] == _EDGE) | (norm[length - 1 :] == _EDGE)
            at = np.flatnonzero(~(inner | edge))
            yield at, _bucket(value[at] + np.uint64(length))
    ends = np.flatnonzero(blank)
    starts, stops = ends[:-1] + 1, ends[1:]
    word = (stops > starts) & (norm[np.minimum(starts, n - 1)] != _EDGE)
    starts, stops = starts[word], stops[word]
    yield starts, _bucket(common.word_hashes(norm, starts, stops))


@dataclass
class Model:
    """What scoring needs: one weight for each bucket, a bias and the calibration."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def logits(self, texts: list[bytes]) -> np.ndarray:
        """The largest window logit of every text; that of no evidence without words."""
        norm = normalise(texts)
        total = np.zeros(len(norm) + 1)
        count = np.zeros(len(norm) + 1)
        for at, bucket in features(norm):
            total[1:][at] += self.weights[bucket]
            count[1:][at] += 1
        total, count = np.cumsum(total), np.cumsum(count)
        first, stop = spans(norm, len(texts), WINDOW // 2)
        out = np.full(len(texts), self.bias)
        for doc, (a, b) in enumerate(zip(first, stop, strict=True)):
            if len(a):
                out[doc] = self.bias + np.max((total[b] - total[a]) / np.maximum(count[b] - count[a], LEAST))
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(texts) + self.offset, -30, 30)))


def spans(norm: np.ndarray, n: int, step: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of each text the byte positions where its windows begin and end.

    A window includes the blank before its first word and ends before the one
    after its last word.
    """
    edges = np.flatnonzero(norm == _EDGE)
    blanks = np.flatnonzero(norm[:-1] == 0x20)
    before = blanks[norm[blanks + 1] != _EDGE]  # the blank before each word
    low = np.searchsorted(before, np.concatenate([[0], edges[:-1]]))[:n]
    high = np.searchsorted(before, edges)[:n]
    first, stop = [], []
    for a, b, edge in zip(low.tolist(), high.tolist(), edges.tolist(), strict=True):
        if a == b:
            first.append(np.zeros(0, np.int64))
            stop.append(np.zeros(0, np.int64))
            continue
        begin = np.arange(a, max(a + 1, b - WINDOW + step), step)
        end = np.minimum(begin + WINDOW, b)
        first.append(before[begin])
        stop.append(np.where(end < b, before[np.minimum(end, b - 1)], edge - 1))
    return first, stop


def window_bags(texts: list[bytes]) -> list[list[np.ndarray]]:
    """The buckets of the windows of every text, which here do not overlap."""
    norm = normalise(texts)
    found = list(features(norm))
    at = np.concatenate([a for a, _ in found])
    bucket = np.concatenate([b for _, b in found])
    order = np.argsort(at, kind="stable")
    at, bucket = at[order], bucket[order]
    first, stop = spans(norm, len(texts), WINDOW)
    out = []
    for a, b in zip(first, stop, strict=True):
        low, high = np.searchsorted(at, a), np.searchsorted(at, b)
        out.append([bucket[x:y] for x, y in zip(low, high, strict=True)])
    return out


def _pieces(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Consecutive texts of some bytes, one text at least."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > common.CHUNK_BYTES:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def fit(texts: list[bytes], labels: np.ndarray, weights_of: np.ndarray | None = None) -> Model:
    """Train on all texts; calibrate on scores of models that saw only the other half.

    ``weights_of`` says how many rows each text stands for. The same data give the
    same model.
    """
    weights_of = np.ones(len(texts)) if weights_of is None else weights_of
    bags = [bag for part in _pieces(texts) for bag in window_bags(part)]
    if len(set(labels.tolist())) < 2 or not any(bags):
        rate = float(np.clip(np.average(labels, weights=weights_of) if len(labels) else 0.0, 0.01, 0.99))
        return Model(np.zeros(1 << BUCKET_BITS), 0.0, 0.0, float(np.log(rate / (1 - rate))))
    half = np.zeros(len(bags), dtype=np.int64)
    for value in (0, 1):  # as many of either label in both halves
        half[np.flatnonzero(labels == value)[::2]] = 1
    unseen = np.zeros(len(bags))
    for part in (0, 1):
        weights, bias = _fit([b for b, h in zip(bags, half, strict=True) if h != part], labels[half != part])
        held = np.flatnonzero(half == part)
        model = Model(weights, bias, 1.0, 0.0)
        unseen[held] = np.concatenate([model.logits(p) for p in _pieces([texts[i] for i in held])])
    weights, bias = _fit(bags, labels)
    return Model(weights, bias, *_calibrate(unseen, labels, weights_of))


def _fit(bags: list[list[np.ndarray]], labels: np.ndarray, passes: int = 6, seed: int = 7) -> tuple[np.ndarray, float]:
    """Embeddings and softmax, trained together by Adagrad, as one weight for each bucket and a bias."""
    random = np.random.default_rng(seed)
    table = random.uniform(-1, 1, (1 << BUCKET_BITS, SIZE)).astype(np.float32) / SIZE
    soft = np.zeros((SIZE, 2), dtype=np.float32)
    soft[:, 1] = random.normal(0, 0.5, SIZE)
    soft[:, 0] = -soft[:, 1]
    bias = np.zeros(2, dtype=np.float32)
    table_sq = np.full(1 << BUCKET_BITS, 1e-8, dtype=np.float32)
    soft_sq, bias_sq = np.full_like(soft, 1e-8), np.full_like(bias, 1e-8)
    doc = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    windows = [w for b in bags for w in b]
    if not windows:
        return np.zeros(1 << BUCKET_BITS), 0.0
    sizes = np.array([len(w) for w in windows])
    flat = np.concatenate(windows)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    target = labels[doc].astype(np.int64)

    def gathered(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = sizes[chosen]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return flat[np.repeat(begin[chosen], n) + inside], n

    def weights_now() -> np.ndarray:
        return (table @ (soft[:, 1] - soft[:, 0])).astype(np.float64)

    def window_logits() -> np.ndarray:
        weights, out = weights_now(), np.zeros(len(sizes))
        for low in range(0, len(sizes), 4096):  # some windows at a time, all of them
            high = min(low + 4096, len(sizes))
            value = np.concatenate([[0.0], np.cumsum(weights[flat[begin[low] : begin[high]]])])
            at = begin[low : high + 1] - begin[low]
            out[low:high] = value[at[1:]] - value[at[:-1]]
        return out / np.maximum(sizes, LEAST) + float(bias[1] - bias[0])

    batch = min(256, max(16, len(windows) // 200))
    epochs = max(passes, min(24, -(-1500 * batch // len(windows))))  # 1500 steps at least on small samples
    for epoch in range(epochs):
        use = np.ones(len(windows), dtype=bool)
        if epoch >= 2:  # of toxic texts, the windows that look most toxic
            logit = window_logits()
            rank = np.lexsort((-logit, doc))
            place = np.arange(len(rank)) - np.searchsorted(doc[rank], doc[rank])
            use[rank] = (target[rank] == 0) | (place < (4 if epoch < 3 else 2))
        ids = np.flatnonzero(use)
        positive = max(1, int(target[ids].sum()))
        weight = np.where(target == 1, max(1.0, (len(ids) - positive) / positive / 4), 1.0)
        for chosen in np.array_split(random.permutation(ids), max(1, len(ids) // batch)):
            bucket, n = gathered(chosen)
            share = np.maximum(n, LEAST)[:, None]
            hidden = np.add.reduceat(table[bucket], np.cumsum(n) - n) / share
            out = hidden @ soft + bias
            p = np.exp(out - out.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(chosen)), target[chosen]] -= 1
            grad = p * (weight[chosen] / len(chosen))[:, None]
            back = (grad @ soft.T) / share
            g = hidden.T @ grad
            soft_sq += g * g
            soft -= 0.1 * g / np.sqrt(soft_sq)
            g = grad.sum(0)
            bias_sq += g * g
            bias -= 0.1 * g / np.sqrt(bias_sq)
            seen, place = np.unique(bucket, return_inverse=True)
            rows = np.repeat(np.arange(len(chosen)), n)
            g = np.stack([np.bincount(place, back[rows, k], len(seen)) for k in range(SIZE)], 1)
            table_sq[seen] += (g * g).mean(1)
            table[seen] -= (0.1 * g / np.sqrt(table_sq[seen])[:, None]).astype(np.float32)
    return weights_now(), float(bias[1] - bias[0])


def _calibrate(logit: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability, by Newton steps on smoothed labels."""
    positive = label.sum()
    wanted = np.where(label == 1, (positive + 1) / (positive + 2), 1 / (len(label) - positive + 2))
    weight = weight / weight.mean()
    scale = max(float(np.std(logit)), 1e-6)
    x = np.stack([logit / scale, np.ones(len(logit))], 1)
    at = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        gradient = x.T @ (weight * (p - wanted)) + 1e-3 * at
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        at -= np.clip(step, -2, 2)
    return float(at[0] / scale), float(at[1])


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fit on the sample; ``labels`` holds the rows that may teach.

    Null ids, labels and labelled ids without a document are left out. If rows of
    one id disagree, the largest label counts; of several documents of an id the one
    of the smallest hash teaches. Each label gives half of the rows, or what the other
    one leaves. Without two classes to tell apart, every score is the share of the class.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(id_column).isNotNull())
    known = known.groupBy(F.col(id_column).alias("__id")).agg((F.max(label) > 0).cast("int").alias("__label"))
    there = dict(known.groupBy("__label").count().collect())
    take = {v: min(there.get(v, 0), max(SAMPLE_ROWS // 2, SAMPLE_ROWS - there.get(1 - v, 0))) for v in (0, 1)}
    drawn = [known.where(F.col("__label") == v).orderBy(F.xxhash64("__id"), "__id").limit(take[v]) for v in (0, 1)]
    sample = docs.join(F.broadcast(drawn[0].unionByName(drawn[1])), F.col(id_column) == F.col("__id"))
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    one = sample.groupBy("__id", "__label").agg(F.min_by(whole, F.struct(F.xxhash64(whole), whole)).alias("__text"))
    rows = sorted(one.collect(), key=lambda r: r["__id"])  # SAMPLE_ROWS at most
    targets = np.array([r["__label"] for r in rows], dtype=np.int64)
    weight = np.array([there[v] / max(1, int((targets == v).sum())) for v in targets.tolist()])
    model = fit([r["__text"].encode() for r in rows], targets, weight)
    common.release()  # the driver lives on for the stages that follow
    return model


def score(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``toxicity`` (double, 0 to 1). A null, empty or wordless text gets the score of no evidence."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # one weight a bucket: 512 KB

    def make():
        return lambda texts: [shared.value.scores(texts.encoded())]

    return common.with_text_columns(df, text, [("toxicity", T.DoubleType())], make, keep)


def clean(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with their own columns."""
    apart, back = common.set_aside(docs, ["toxicity"])
    return common.restored(score(apart, model, back.get(text, text)).where(F.col("toxicity") < threshold), docs, back)
