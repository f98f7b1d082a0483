"""Spelling variants and ranked search against plain Python."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from basketry.llm import lexical, spelling

DOCS = "doc_id long, text string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- spelling variants -----------------------------------------------------------


def counted(rows):
    counts = Counter()
    for i, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = lower(word)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 97 == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def expected_variants(rows):
    words = counted(rows)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (n, len(near[w]), form[w], words.get(form[w]), root(w)) for w, n in words.items()}


def variant_rows(df):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


@pytest.fixture(scope="module")
def misspelt():
    rng = random.Random(11)
    stems = ["".join(rng.choices("abéÿo", k=rng.randint(4, 9))) for _ in range(60)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(150):
            word = stems[min(int(rng.expovariate(0.08)), len(stems) - 1)]
            for _ in range(rng.choice([0, 0, 0, 1, 2])):
                k = rng.randrange(len(word) + 1)
                word = rng.choice([word[:k] + rng.choice("abo") + word[k:], word[:k] + word[k + 1 :], word[:k] + "b" + word[k + 1 :]])
            words.append(word.upper() if rng.random() < 0.1 else word)
        rows.append((i, rng.choice([" ", "-", "1", " ßĀ "]).join(words)))
    return rows


@pytest.mark.parametrize("block", [1 << 13, 40])
def test_variants_equal_all_pairs(spark, misspelt, monkeypatch, block):
    rows = [*misspelt, (1000, None), (1001, ""), (None, "nameless " * 4), misspelt[0]]
    expected = expected_variants(rows)
    monkeypatch.setattr(spelling.nearest, "__defaults__", (spelling.LETTERS, block))
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    assert variant_rows(spelling.variants(docs)) == expected
    assert sum(v[2] is not None for v in expected.values()) > 20
    assert any(v[2] is not None and expected[v[2]][2] is not None for v in expected.values())  # a chain


def test_position_index_finds_single_edits():
    rng = random.Random(5)
    words = sorted({"".join(rng.choices("abé", k=rng.randint(1, 7))) for _ in range(400)})
    index = spelling.PositionIndex(words)
    for word in words:
        assert {words[i] for i in index.members(index.near(word))} == {v for v in words if one_edit(word, v)}


def test_near_words_meet_in_one_block():
    rng = random.Random(6)
    words = ["".join(rng.choices("ab", k=rng.randint(5, 9))) for _ in range(120)]
    for a in words:
        for b in words:
            if one_edit(a, b):
                where = spelling.meeting_block(a, b, 1000)
                assert where == spelling.meeting_block(b, a, 1000)
                assert where in spelling.blocks_of(a, 1000) and where in spelling.blocks_of(b, 1000)


def test_variants_edge_cases(spark, edge_docs):
    assert spelling.variants(edge_docs.limit(0)).collect() == []
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    assert variant_rows(spelling.variants(edge_docs)) == expected_variants(rows)
    clash = spark.createDataFrame([(1, "tokens Tokens toKens taken tokenz tokenz tokenz", "own", "own")], "doc_id long, text string, word string, n string")
    assert variant_rows(spelling.variants(clash)) == expected_variants([(1, "tokens Tokens toKens taken tokenz tokenz tokenz")])


# --- ranked search -----------------------------------------------------------------


def split_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


def expected_ranks(rows, items, k):
    docs = [(i, Counter(split_terms(t)), len(split_terms(t))) for i, t in rows if split_terms(t)]
    number, total = len(docs), sum(n for *_, n in docs)
    held = Counter(term for _, c, _ in docs for term in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in docs:
            m = 75 + 25 * n * number // total
            score = 0
            for term in split_terms(text):
                if c[term]:
                    w = math.floor(1000 * math.log((2 * number + 2) / (2 * held[term] + 1)))
                    score += w * (1_000_000_000 * c[term] // (1000 * c[term] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        scored.sort(key=lambda s: s[:3])
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def ranks(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=repr)


ITEMS = [(1, "One Two, one THREE é!"), (2, "four four four five"), (3, "nowhere"), (4, ""), (5, None), (7, "tie one two three four five")]


@pytest.fixture(scope="module")
def small_docs():
    rng = random.Random(2)
    words = "one two three four five six é seven_eight 9 nine".split()
    rows = [(i, rng.choice([" ", ". "]).join(rng.choices(words, k=rng.randint(0, 12)))) for i in range(300)]
    return [*rows, (900, None), (901, ""), (None, "one two"), (None, "one two"), (5, rows[5][1]), (902, "One " * 5000)]


@pytest.mark.parametrize("documents, terms, exact", [(512, 2048, 1 << 53), (7, 3, 3_000_000_000)])
def test_ranks_equal_plain_scores(spark, small_docs, monkeypatch, documents, terms, exact):
    monkeypatch.setattr(lexical, "DOCUMENTS", documents)
    monkeypatch.setattr(lexical.Items.weigh, "__defaults__", (terms, exact))
    docs = spark.createDataFrame(small_docs, DOCS).repartition(3)
    items = spark.createDataFrame([*ITEMS, (None, "one")], "item_id long, text string")
    assert ranks(lexical.rank(docs, items, 20)) == expected_ranks(small_docs, [i for i in ITEMS if i[1] is not None], 20)


def test_several_blocks_of_items(spark, small_docs, monkeypatch):
    monkeypatch.setattr(lexical, "ITEMS", 2)
    docs = spark.createDataFrame(small_docs, DOCS)
    items = spark.createDataFrame([(str(i), t) for i, t in ITEMS], "name string, text string")
    named = [(str(i), t) for i, t in ITEMS if t is not None]
    found = lexical.rank(docs, items, 3, item_id="name")
    assert ranks(found) == expected_ranks(small_docs, named, 3)


def test_tiles_stay_exact():
    rng = random.Random(4)
    rows = [(str(i), " ".join(f"w{rng.randint(0, 60)}" for _ in range(200)) + " heavy" * 50) for i in range(9)]
    items = lexical.Items(rows)
    exact = 40_000 * lexical.IMPACT
    items.weigh(1000, np.arange(len(items.vocabulary)) % 50, 8, exact)
    whole = np.zeros((len(rows), len(items.vocabulary)), dtype=np.int64)
    for chosen, first, item, weight in items.tiles:
        assert len(chosen) <= 8
        tile = np.zeros_like(whole)
        np.add.at(tile, (item, np.repeat(chosen, np.diff(first))), weight)
        assert tile.sum(axis=1).max() * lexical.IMPACT < exact
        whole += tile
    items.weigh(1000, np.arange(len(items.vocabulary)) % 50)
    (chosen, first, item, weight), = items.tiles
    one = np.zeros_like(whole)
    np.add.at(one, (item, np.repeat(chosen, np.diff(first))), weight)
    assert (whole == one).all()


def test_ranks_edge_cases(spark, edge_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    assert ranks(lexical.rank(edge_docs, items)) == expected_ranks(rows, [i for i in ITEMS if i[1] is not None], 20)
    assert lexical.rank(edge_docs.limit(0), items).collect() == []
    assert lexical.rank(edge_docs, items.limit(0)).collect() == []
    assert lexical.length_factor(np.array([10**9]), 10**12, 10**15).tolist() == [75 + 25 * 10**6]
