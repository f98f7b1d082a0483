from __future__ import annotations

import random

import pytest

LONG = " ".join(f"word{i}" for i in range(40_000))
EDGE = [
    (1, None), (2, ""), (3, " \t\n "), (4, "a"), (5, LONG), (5, LONG), (6, LONG + " more"), (None, "no id at all, but six words"),
    (None, None), (7, "tie one two three four five"), (8, "tie one two three four five"), (9, "é\U0001f600 \x00 <|im_end|> é"),
]
#: Names that operators use for their results.
CLASHES = (
    "n_words n_hit hit_spans hit_items toxicity quality_score n_shingles component_id class_id set_id prefix n_lines n_kept "
    "n_tokens token_ids decoded candidates verdicts key place"
).split()


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and long texts, repeated rows and ties, with columns that clash with results."""
    schema = "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in CLASHES)
    return spark.createDataFrame([(i, t, None, *["own"] * len(CLASHES)) for i, t in EDGE], schema)


@pytest.fixture(scope="session")
def corpus():
    """Random texts with exact and near copies, shared passages and repeated lines."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(400)]
    line = lambda n: " ".join(rng.choices(words, k=n))
    passage = line(60)
    texts: list[str | None] = [None, "", "one", "two words", passage]
    for _ in range(120):
        texts.append("\n".join(line(rng.randint(3, 30)) for _ in range(rng.randint(1, 8))))
    for _ in range(60):
        copy = rng.choice(texts[5:65]).split(" ")
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        texts.append(" ".join(copy))
    base = line(80).split(" ")
    for _ in range(60):  # a large group of near copies, some too far from others
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        texts.append(" ".join(copy))
    for i in range(10, 30):
        texts[i] = f"{texts[i]}\n{passage}"
    return list(enumerate(texts))
