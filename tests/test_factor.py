"""Factor models: seeded, complete, and better than chance."""

from __future__ import annotations

import datetime as dt
import random
import time

import numpy as np
import pytest

from basketry.operators import combine, evaluate, factor, inner, windows
from basketry.plans import recommend

REF = dt.date(2020, 1, 22)


@pytest.fixture(scope="module")
def taste(spark, purchases):
    """Customers of six tastes who mostly buy the five articles of their taste."""
    rng = random.Random(3)
    rows = []
    for c in range(60):
        for _ in range(14):
            group = c % 6 if rng.random() < 0.9 else rng.randrange(6)
            rows.append(
                (dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(28)), f"c{c:02d}", f"a{group}{rng.randrange(5)}")
            )
    population = spark.createDataFrame([(f"c{c:02d}",) for c in range(62)], "customer_id string")
    return purchases(rows).cache(), population


SETTINGS = factor.FactorSettings(rank=6, iterations=6)


def test_als_beats_random_lists(spark, taste):
    tx, population = taste
    train, valid = windows.temporal_split(tx, REF)
    lists = recommend.als(train, population, SETTINGS)
    rows = lists.collect()
    assert len(rows) == 62 and all(len(r["items"]) == 12 for r in rows)
    rng = random.Random(1)
    every = [f"a{g}{i}" for g in range(6) for i in range(5)]
    noise = spark.createDataFrame(
        [(r["customer_id"], rng.sample(every, 12)) for r in rows], "customer_id string, items array<string>"
    )
    model = evaluate.map_at_k(valid, lists).first()["map"]
    assert model > 1.5 * evaluate.map_at_k(valid, noise).first()["map"]


def test_als_is_seeded(taste):
    tx, population = taste
    runs = [sorted(map(str, recommend.als(tx, population, SETTINGS).collect())) for _ in range(2)]
    assert runs[0] == runs[1]


def test_customers_without_factors_get_the_best_sellers(taste):
    tx, population = taste
    lists = {r["customer_id"]: r["items"] for r in recommend.als(tx, population, SETTINGS).collect()}
    assert lists["c60"] == lists["c61"]


def test_validation_and_grid(taste):
    tx, _ = taste
    alone = factor.als_validation(tx, REF, SETTINGS).first()["map"]
    grid = [factor.FactorSettings(rank=2, iterations=1), SETTINGS]
    scores = factor.grid_search(tx, REF, grid).collect()
    assert [r["factors"] for r in scores] == [2, 6]
    assert [r["best"] for r in scores].count(True) == 1
    assert scores[1]["map"] == pytest.approx(alone, abs=1e-6)
    assert max(scores, key=lambda r: r["map"])["best"]
    assert len(factor.full_grid()) == 35


def test_rerank_orders_own_articles_by_prediction(taste):
    tx, population = taste
    for ascending in (True, False):
        ranked = factor.mf_reranked_items(
            tx, "2020-01-01", REF, settings=SETTINGS, ascending=ascending
        ).orderBy("customer_id", "rank").collect()
        own = {(r["customer_id"], r["article_id"]) for r in tx.collect()}
        assert ranked and all((r["customer_id"], r["article_id"]) in own for r in ranked)
        for a, b in zip(ranked, ranked[1:]):
            if a["customer_id"] == b["customer_id"]:
                assert (a["predicted"] <= b["predicted"]) if ascending else (a["predicted"] >= b["predicted"])
    lists = recommend.mf_rerank(tx, population, "2020-01-01", REF, settings=SETTINGS)
    assert lists.count() == 62
    assert combine.to_predictions(lists).where("prediction = ''").count() == 0


def plain_best(users, items, k):
    out = {}
    for user, u in users:
        scored = sorted(((-float(np.dot(np.float64(u), np.float64(i))), item) for item, i in items))[:k]
        out[user] = [item for _, item in scored]
    return out


@pytest.mark.parametrize("part_bytes, block", [(32 << 20, 512), (8 * 6 * 50, 7), (8 * 6 * 3, 2)])
def test_best_items_equal_the_full_product(spark, monkeypatch, part_bytes, block):
    monkeypatch.setattr(inner, "PART_BYTES", part_bytes)
    monkeypatch.setattr(inner, "BLOCK", block)
    rng = np.random.default_rng(3)
    items = [(i, [float(x) for x in rng.integers(-4, 5, 6) * (1 + (i % 10 == 0) * 3)]) for i in range(180)]  # many ties
    users = [(u, [float(x) for x in rng.integers(-4, 5, 6)]) for u in range(60)] + [(99, [0.0] * 6)]
    frame = lambda rows: spark.createDataFrame(rows, "id int, features array<float>")
    found = inner.best_items(frame(users), frame(items), 5)
    got = {u: [] for u, _ in users}
    for r in found.orderBy("id", "rank").collect():
        got[r["id"]].append(r["item"])
    assert got == plain_best(users, items, 5)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "Join" not in text


def test_best_items_skip_blocks_of_small_norm():
    rng = np.random.default_rng(1)
    factors = rng.normal(size=(20 * inner.BLOCK, 8)) * (1 / (1 + np.arange(20 * inner.BLOCK)))[:, None]
    items = inner.Items(np.arange(len(factors)), factors)
    users = rng.normal(size=(40, 8))
    ids, scores = np.full((40, 5), 1 << 60), np.full((40, 5), -np.inf)
    assert items.best(users, ids, scores) < 40 * 20 / 2
    whole = users @ factors.T
    assert (ids == np.argsort(-whole, axis=1, kind="stable")[:, :5]).all()


def test_best_items_of_few_or_none(spark):
    frame = lambda rows: spark.createDataFrame(rows, "id int, features array<float>")
    one = inner.best_items(frame([(1, [1.0]), (2, [-1.0])]), frame([(7, [2.0])]), 3)
    assert sorted(map(tuple, one.collect())) == [(1, 1, 7, 2.0), (2, 1, 7, -2.0)]
    assert inner.best_items(frame([(1, [1.0])]), frame([]), 3).collect() == []
    assert inner.best_items(frame([]), frame([(1, [1.0])]), 3).collect() == []


def test_settings_are_fitted_at_the_same_time(spark, purchases, monkeypatch):
    spans = []
    lists = factor.als_lists

    def timed(*args):
        start = time.monotonic()
        found = lists(*args)
        found.count()
        spans.append((start, time.monotonic()))
        return found

    monkeypatch.setattr(factor, "als_lists", timed)
    rng = random.Random(1)
    tx = purchases([(REF + dt.timedelta(days=rng.randrange(-20, 3)), f"c{rng.randrange(12)}", f"a{rng.randrange(15)}") for _ in range(300)])
    grid = [factor.FactorSettings(4, 2), factor.FactorSettings(5, 2)]
    together = [tuple(r) for r in factor.grid_search(tx, REF, grid, parallel=2).collect()]
    (a, b), (c, d) = sorted(spans)
    assert c < b  # the second began before the first ended
    assert together == [tuple(r) for r in factor.grid_search(tx, REF, grid, parallel=1).collect()]
