"""Repeated substrings against plain Python."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from basketry.llm import suffix_dedup

DOCS = "doc_id long, text string"


def expected_removals(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    counts = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for (i, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if counts[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        runs = sum(g and not before for g, before in zip(gone, b"\0" + gone))
        out.append((i, len(t), sum(gone), runs, bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out, key=repr)


def removals(df):
    rows = df.collect()
    for r in rows:
        assert sum(s["end"] - s["first"] for s in r["removed"]) == r["n_removed"]
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in rows), key=repr)


@pytest.fixture(scope="module")
def passages():
    """Random texts that share passages, some exactly as long as the strings, and periodic ones."""
    rng = random.Random(8)
    letters = "abc dé\U0001f600\x00\n"
    text = lambda n: "".join(rng.choices(letters, k=n))
    shared = [text(n) for n in (19, 20, 21, 30, 60, 200)]
    texts = ["a" * 90, "ab" * 70, "a" * 20, "a" * 19, "x" * 21, "", None]
    for _ in range(150):
        texts.append(text(rng.randint(0, 80)) + rng.choice(shared) + text(rng.randint(0, 80)) + rng.choice(["", rng.choice(shared)]))
    for _ in range(40):
        copy = list(rng.choice(texts[10:80]))
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = rng.choice(letters)
        texts.append("".join(copy))
    texts += [shared[5], shared[5][3:]] + [texts[9]] * 5
    return list(enumerate(texts))


@pytest.mark.parametrize("range_bytes, held, frequent", [(4 << 20, 16 << 20, 8), (500, 300, 8), (2000, 1, 2)])
def test_equals_plain_search(spark, passages, monkeypatch, range_bytes, held, frequent):
    monkeypatch.setattr(suffix_dedup, "RANGE_BYTES", range_bytes)
    monkeypatch.setattr(suffix_dedup, "FREQUENT", frequent)
    monkeypatch.setattr(suffix_dedup.shards, "__defaults__", (held,))
    docs = spark.createDataFrame(passages, DOCS).repartition(4)
    found = suffix_dedup.remove_repeats(docs, length=20, anchor=6)
    assert removals(found) == expected_removals(passages, 20)


def test_long_strings(spark, corpus):
    docs = spark.createDataFrame(corpus, DOCS).repartition(3)
    expected = expected_removals(corpus, 200)
    assert sum(r[2] > 0 for r in expected) > 40
    assert removals(suffix_dedup.remove_repeats(docs)) == expected


def test_edge_cases(spark, edge_docs):
    assert suffix_dedup.remove_repeats(edge_docs.limit(0)).collect() == []
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    found = suffix_dedup.remove_repeats(edge_docs)
    assert set(edge_docs.columns) | {"n_bytes", "n_removed", "n_spans", "removed", "kept"} == set(found.columns)
    assert removals(found) == expected_removals(rows, 200)
    clash = spark.createDataFrame([(1, "x" * 201, "own", "own", "own"), (2, "y" * 300, None, None, None)], "doc_id long, text string, kept string, spans string, key string")
    assert [(r["doc_id"], r["n_removed"], r["key"]) for r in suffix_dedup.remove_repeats(clash).orderBy("doc_id").collect()] == [(1, 201, "own"), (2, 300, None)]


def shards_of(rng, number):
    """Contexts with their ends in order, as shards; some contexts in several shards."""
    base = [bytes(rng.choices(b"ab", k=rng.randint(20, 45))) for _ in range(25)]
    made = []
    for _ in range(number):
        chosen = {rng.choice(base)[rng.randint(0, 4) :] for _ in range(rng.randint(1, 12))}
        made.append(sorted(chosen, key=lambda c: c + b"\xff"))
    return made


def test_transform_spells_contexts():
    rng = random.Random(3)
    for contexts in shards_of(rng, 20):
        rows = []
        for j, c in enumerate(contexts):
            cycle = c + b"\xff"
            rows += [(cycle[k:], j, cycle[k - 1]) for k in range(len(cycle))]
        assert list(suffix_dedup.transform(contexts)) == [r[2] for r in sorted(rows)]


@pytest.mark.parametrize("depth", [8, 13, 20, 33])
def test_merge_orders_and_finds_common_prefixes(depth):
    rng = random.Random(depth)
    shards = shards_of(rng, 7)
    merged = suffix_dedup.Merged([np.frombuffer(suffix_dedup.transform(c), dtype=np.uint8) for c in shards], depth)
    flat = [c for contexts in shards for c in contexts]
    counts = np.array([len(c) + 1 for c in flat])
    context, number, row = merged.starts(counts)
    assert sorted(row.tolist()) == list(range(len(merged.order)))
    suffix = {}
    for c, k, r in zip(context.tolist(), number.tolist(), row.tolist()):
        cycle = flat[c] + b"\xff"
        suffix[r] = (cycle[k:] + cycle * 3)[:depth]
    spelt = [suffix[r] for r in merged.order.tolist()]
    assert spelt == sorted(spelt)
    for i in range(1, len(spelt)):
        agreed = next((k for k in range(depth) if spelt[i][k] != spelt[i - 1][k]), depth)
        assert merged.agree[i] <= agreed
        assert (merged.agree[i] == depth) == (agreed == depth)


def test_frequent_anchors_come_last():
    rng = random.Random(9)
    passage = "".join(rng.choices("abcdefgh", k=120))
    texts = ["".join(rng.choices("abcdefgh", k=200)) + passage + "".join(rng.choices("abcdefgh", k=200)) for _ in range(30)]
    import pyarrow as pa

    from basketry.llm import common

    chunk = common.Texts(pa.array(texts))
    grams = np.unique(suffix_dedup._hashed(np.frombuffer(passage.encode(), np.uint8), 6)[0])
    plain = suffix_dedup.Stretches(chunk, np.zeros(0, np.uint64), 40, 6)
    late = suffix_dedup.Stretches(chunk, grams, 40, 6)
    assert len(np.unique(late.anchor)) > len(np.unique(plain.anchor))
    inside = lambda s: max(Counter(s.anchor.tolist()).values())
    crossing = lambda s: sum((s.first < 200) & (s.first + s.count > 180) & np.isin(s.anchor, [a for a, n in Counter(s.anchor.tolist()).items() if n >= 30]))
    assert inside(late) <= inside(plain) and crossing(late) <= crossing(plain)
