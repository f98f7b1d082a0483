"""Hand-checked cases."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from basketry.functions import dates, keys, lists, text
from basketry.operators import combine, evaluate, history, popularity, related, trend, windows
from basketry.operators.factor import normalised_feedback
from basketry.plans import recommend


def day(text_):
    return dt.date.fromisoformat(text_)


def one(spark, column, schema="x int", row=(1,)):
    return spark.createDataFrame([row], schema).select(column.alias("v")).first()["v"]


# --- scalar functions ---------------------------------------------------------


@pytest.mark.parametrize(
    "t, expected",
    [
        ("2020-09-22", "2020-09-22"),
        ("2020-09-16", "2020-09-22"),
        ("2020-09-15", "2020-09-15"),
        ("2020-09-10", "2020-09-15"),
    ],
)
def test_week_bucket(spark, t, expected):
    got = one(spark, dates.week_bucket("t", "2020-09-22"), "t date", (day(t),))
    assert got == day(expected)


def test_week_id(spark):
    assert one(spark, dates.week_id("t", "2020-09-22"), "t date", (day("2020-09-16"),)) == 104
    assert one(spark, dates.week_id("t", "2020-09-22"), "t date", (day("2020-09-15"),)) == 103


def test_age_bins(spark):
    ages = [(-1,), (0,), (19,), (20,), (119,), (120,), (None,)]
    df = spark.createDataFrame(ages, "age int")
    got = [r[0] for r in df.select(keys.bin_column("age", popularity.AGE_EDGES)).collect()]
    assert got == [0, 0, 0, 1, 6, 0, 0]
    kept = [r[0] for r in df.select(keys.bin_column("age", popularity.AGE_EDGES, None)).collect()]
    assert kept == [None, 0, 0, 1, 6, None, None]


def test_decay(spark):
    days = dates.day_diff("2020-09-16", "t")
    assert one(spark, dates.inverse_days(days), "t date", (day("2020-09-15"),)) == 1.0
    assert one(spark, dates.inverse_days(days), "t date", (day("2020-09-08"),)) == 0.125
    assert one(spark, dates.mixed_days("x")) == pytest.approx(146809.61, abs=0.01)
    assert one(spark, dates.mixed_days("x"), row=(0,)) == one(spark, dates.mixed_days("x"))
    assert one(spark, dates.mixed_days("x"), row=(5000,)) == 0.0
    assert one(spark, dates.exp_days("x"), row=(2,)) == pytest.approx(math.exp(-2))


def test_hash_key(spark):
    full = "0" * 48 + "f" * 16
    assert one(spark, keys.hash_key("c"), "c string", (full,)) == -1
    assert int(one(spark, keys.hash_key("c", False), "c string", (full,))) == 2**64 - 1


def test_article_key_keeps_the_zero(spark):
    assert one(spark, keys.article_key("a"), "a string", ("0108775015",)) == 108775015
    assert one(spark, keys.article_label("a"), "a bigint", (108775015,)) == "0108775015"
    assert one(spark, keys.product_code("a"), "a string", ("0108775015",)) == 108775


def test_strings(spark):
    assert one(spark, keys.string_to_ids("s"), "s string", ("  a b  c ",)) == ["a", "b", "c"]
    assert one(spark, keys.string_to_ids("s"), "s string", ("",)) == []
    thirteen = " " + " ".join(f"{i:010d}" for i in range(13))
    cut = one(spark, keys.truncate_prediction("s"), "s string", (thirteen,))
    assert cut.split() == [f"{i:010d}" for i in range(12)] and len(cut) == 131


def test_text(spark):
    assert one(spark, text.word_count("s"), "s string", (" two\n words ",)) == 2
    assert one(spark, text.word_count("s"), "s string", ("",)) == 0
    assert one(spark, text.ngrams(text.tokens("s"), 2), "s string", ("a b c",)) == ["a b", "b c"]
    assert one(spark, text.ngrams(text.tokens("s"), 2), "s string", ("a",)) == []


def test_list_functions(spark):
    row = (["a", "b"], ["b", "c", "d"])
    schema = "p array<string>, q array<string>"
    assert one(spark, lists.list_fill("p", "q", 4), schema, row) == ["a", "b", "b", "c"]
    assert one(spark, lists.list_fill("p", "q", 4, True), schema, row) == ["a", "b", "c", "d"]
    assert one(spark, lists.list_fill("p", "q", 2), schema, (None, ["b"])) == ["b"]
    assert one(spark, lists.list_stack("p", "q", "p", k=6), schema, row) == list("abbcda")
    assert one(spark, lists.list_cut("q", 1), schema, row) == ["b"]


# --- average precision ----------------------------------------------------------


@pytest.mark.parametrize(
    "actual, predicted, expected",
    [
        (["a", "b", "c"], ["a", "x", "b"], (1 + 2 / 3) / 3),
        (["a", "a", "c"], ["a", "a", "b"], 1 / 3),
        (["m"], [*"abcdefghijkl", "m"], 0.0),
        (["z"], ["a"], 0.0),
        (["a"], [], 0.0),
    ],
)
def test_average_precision(spark, actual, predicted, expected):
    bought = spark.createDataFrame([("u", a) for a in actual], "customer_id string, article_id string")
    lists_ = spark.createDataFrame([("u", predicted)], "customer_id string, items array<string>")
    assert evaluate.ap_at_k(bought, lists_).first()["ap"] == pytest.approx(expected, abs=1e-6)


def test_only_buyers_are_scored(spark):
    bought = spark.createDataFrame([("u", "a"), ("v", "b")], "customer_id string, article_id string")
    lists_ = spark.createDataFrame(
        [("u", ["a"]), ("w", ["a"])], "customer_id string, items array<string>"
    )
    row = evaluate.map_at_k(bought, lists_).first()
    assert (row["map"], row["customers"]) == (0.5, 2)
    groups = spark.createDataFrame([("u", 1), ("v", 2), ("w", 2)], "customer_id string, segment int")
    got = {r["segment"]: r["map"] for r in evaluate.map_by_group(bought, lists_, groups).collect()}
    assert got == {"All": 0.5, "1": 1.0, "2": 0.0}


def test_fill_rate(spark):
    rows = [("a", ["x"] * 12), ("b", ["x"] * 6), ("c", [])]
    df = spark.createDataFrame(rows, "customer_id string, items array<string>")
    assert evaluate.fill_rate(df).first()["fill"] == 50.0


def test_submission_check(spark):
    population = spark.createDataFrame([("a",), ("b",)], "customer_id string")
    good = spark.createDataFrame([("a", ""), ("b", "")], "customer_id string, prediction string")
    bad = spark.createDataFrame(
        [("a", ""), ("a", ""), ("z", "")], "customer_id string, prediction string"
    )
    assert tuple(evaluate.submission_check(good, population).first()) == (0, 0, 0)
    assert tuple(evaluate.submission_check(bad, population).first()) == (1, 1, 1)


# --- lists ---------------------------------------------------------------------------


def long_list(spark, text_):
    rows = [("u", i, item) for i, item in enumerate(text_.split(), start=1)]
    return spark.createDataFrame(rows, "customer_id string, rank bigint, article_id string")


@pytest.mark.parametrize(
    "texts, weights, expected",
    [
        (["a b", "b c", "c d"], [100, 10, 1], [("a", 100), ("b", 60), ("c", 6), ("d", 0.5)]),
        (["a b", "b a"], [1, 1], [("a", 1.5), ("b", 1.5)]),
        (["a b", "c"], [1, -1], [("a", 1), ("b", 0.5)]),
        (["a b"], None, [("a", 1), ("b", 0.5)]),
    ],
)
def test_blend(spark, texts, weights, expected):
    got = combine.blend([long_list(spark, t) for t in texts], weights).orderBy("rank").collect()
    assert [(r["article_id"], r["score"]) for r in got] == expected


def test_prune(spark):
    allowed = spark.createDataFrame([("a",), ("c",)], "article_id string")
    got = combine.prune(long_list(spark, "a b a c"), allowed).orderBy("rank").collect()
    assert [r["article_id"] for r in got] == ["a", "c"]


def test_map_list_keeps_order_and_drops_the_rest(spark):
    mapping = spark.createDataFrame([("a", "x"), ("c", "y")], "article_id string, to string")
    got = related.map_list(long_list(spark, "c b a"), mapping, "to").orderBy("rank").collect()
    assert [(r["rank"], r["article_id"]) for r in got] == [(1, "y"), (2, "x")]


def test_list_length_hist(spark):
    df = spark.createDataFrame([("a", ["x"]), ("b", []), ("c", ["y"])], "customer_id string, items array<string>")
    got = {(r["length"], r["n"]) for r in combine.list_length_hist(df).collect()}
    assert got == {(1, 2), (0, 1)}


# --- counts and orders -----------------------------------------------------------------


def test_channel_group_rounds_half_to_even(spark, purchases):
    tx = purchases(
        [("2020-01-01", "u", "a", 1, 1), ("2020-01-01", "u", "a", 1, 2)]
        + [("2020-01-01", "v", "a", 1, c) for c in (1, 1, 2)]
    )
    population = spark.createDataFrame([("u",), ("v",), ("w",)], "customer_id string")
    got = dict(popularity.population_channel_group(population, tx).collect())
    assert got == {"u": 2, "v": 1, "w": 1}


def test_normalised_feedback(purchases):
    tx = purchases(
        [("2020-01-01", "u", "i")] * 2 + [("2020-01-01", "u", "j")] * 3 + [("2020-01-01", "v", "i")] * 2
    )
    got = normalised_feedback(tx).where("customer_id = 'u' and article_id = 'i'").first()
    assert got["feedback"] == pytest.approx(0.1)


def test_trend_identity(purchases):
    """Whole-number form against the sum over rows that it replaces."""
    last = "2020-09-22"
    tx = purchases(
        [("2020-09-20", "u", "a")] * 3 + [("2020-09-12", "v", "a")] * 2 + [("2020-09-05", "w", "a")] * 4
        + [("2020-09-05", "w", "b")]
    )
    got = {r["article_id"]: r["score"] for r in trend.trend_quotient_sum(tx, last).collect()}
    assert got == {"a": 9, "b": 0}
    rows = popularity.with_weekly_counts(tx, last).groupBy("article_id").agg(
        F.sum(F.col("n_targ") / F.col("n")).alias("s")
    )
    assert {r["article_id"]: round(r["s"], 9) for r in rows.collect()} == {"a": 9.0, "b": 0.0}


def test_popular_order_ties_by_descending_id(purchases):
    tx = purchases(
        [("2020-01-09", "u", "a"), ("2020-01-09", "u", "b"), ("2020-01-09", "u", "c"), ("2020-01-09", "v", "c")]
    )
    got = popularity.popular_items(tx, "2020-01-01", "2020-01-10").orderBy("rank").collect()
    assert [(r["article_id"], r["score"]) for r in got] == [("c", 2.0), ("b", 1.0), ("a", 1.0)]


def test_frequent_first_keeps_first_seen_order(purchases):
    order = ["x", "y", "y", "x", "z"]
    tx = purchases([(dt.date(2020, 1, 1 + i), "u", a) for i, a in enumerate(order)])
    got = history.history_items(tx, "2020-01-01", "2020-02-01").orderBy("rank").collect()
    assert [r["article_id"] for r in got] == ["x", "y", "z"]


def test_items_per_customer_counts_repeats(purchases):
    tx = purchases(
        [("2020-01-02", "u", "b"), ("2020-01-01", "u", "z"), ("2020-01-01", "u", "z"), ("2020-01-02", "u", "a")]
    )
    got = {(r["article_id"], r["position"], r["n"]) for r in history.items_per_customer(tx).collect()}
    assert got == {("z", 1, 2), ("a", 3, 1), ("b", 4, 1)}


# --- siblings -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def shelf(spark):
    rows = [("p", "n1", 1), ("q", "n1", 1), ("r", "n2", 2), ("s", "n2", 2), ("t", "n2", 2), ("v", None, 3), ("w", None, 3)]
    return spark.createDataFrame(rows, "article_id string, prod_name string, product_code int")


def sales(purchases, **counts):
    rows = []
    for article, spec in counts.items():
        n, price = spec if isinstance(spec, tuple) else (spec, 1.0)
        rows += [("2020-01-05", f"c{i}", article, price) for i in range(n)]
    return purchases(rows)


def found(df):
    return {(r["article_id"], r["next_best_article"]) for r in df.collect()}


def test_alternates(purchases, shelf):
    assert found(related.alternates(sales(purchases, p=2, q=5), shelf)) == {("p", "q")}
    assert found(related.alternates(sales(purchases, p=2, q=4), shelf)) == set()
    assert found(related.alternates(sales(purchases, p=2, q=4), shelf, factor=1)) == {("p", "q")}
    assert found(related.alternates(sales(purchases, p=2), shelf)) == set()
    assert found(related.alternates(sales(purchases, v=1, w=9), shelf)) == set()


def test_alternates_price_rule(purchases, shelf):
    dearer = sales(purchases, p=(2, 10.0), q=(5, 12.0))
    cheaper = sales(purchases, p=(2, 10.0), q=(5, 10.0))
    assert found(related.alternates(dearer, shelf, price_rule=True)) == set()
    assert found(related.alternates(cheaper, shelf, price_rule=True)) == {("p", "q")}


def test_alternates_of_larger_groups(purchases, shelf):
    tx = sales(purchases, r=1, s=3, t=9, p=1, q=3)
    assert found(related.alternates(tx, shelf)) == {("r", "t"), ("s", "t"), ("p", "q")}
    assert found(related.alternates(tx, shelf, single_sibling_only=True)) == {("p", "q")}


def test_variants(purchases, shelf):
    tx = sales(purchases, r=1, s=3, t=9, p=2)
    got = {tuple(r) for r in related.variant_map(tx, shelf, "2020-01-05").collect()}
    assert got == {("r", "t"), ("s", "t"), ("t", "s")}


# --- recommenders ----------------------------------------------------------------------------


def items(df):
    return {r["customer_id"]: r["items"] for r in df.collect()}


def test_two_tier(spark, purchases):
    recent, older = ("2020-02-01", "2020-03-01"), ("2020-01-01", "2020-02-01")
    rows = [("2020-02-10", "u", f"r{i:02d}") for i in range(12)]
    rows += [(dt.date(2020, 1, 1 + i), "v", f"o{i}") for i in range(6)]
    tx = purchases(rows)
    population = spark.createDataFrame([("u",), ("v",), ("w",)], "customer_id string")
    got = items(recommend.two_tier(tx, population, recent, older))
    popular = [f"r{i:02d}" for i in reversed(range(12))]
    assert got["v"] == ["o0", "o1", "o2", "o3", *popular[:8]]
    assert got["w"] == popular
    assert got["u"] == sorted(popular)


def test_three_tier(spark, purchases):
    w1, w2, w3 = ("2020-01-15", "2020-01-22"), ("2020-01-08", "2020-01-15"), ("2020-01-01", "2020-01-08")
    rows = [("2020-01-20", "u", f"a{i:02d}") for i in range(13)] + [("2020-01-10", "v", "b")]
    rows += [("2020-01-02", "x", "c")] * 5
    tx = purchases(rows)
    population = spark.createDataFrame([("u",), ("v",), ("x",), ("y",)], "customer_id string")
    got = items(recommend.three_tier(tx, population, [w1, w2, w3]))
    ordered = [f"a{i:02d}" for i in range(13)]
    assert got["u"] == ordered[:12]
    assert got["v"] == ["b", *ordered[:11]]
    assert got["x"] == ["c", "c", *ordered[:10]]
    assert got["y"] == ordered[:12]


def test_cut_never_exceeds_k(spark, purchases):
    """Four windows of twelve articles each still give twelve, from the newest window."""
    ws = windows.back_windows("2020-02-01", 7, 4)
    rows = [
        (start, "u", f"{w}{i:02d}") for w, (start, _) in enumerate(ws) for i in range(12)
    ]
    population = spark.createDataFrame([("u",)], "customer_id string")
    got = items(recommend.stacked(purchases(rows), population, ws))
    assert got["u"] == [f"0{i:02d}" for i in range(12)]


def test_stacked_dedup(spark, purchases):
    ws = windows.back_windows("2020-02-01", 7, 2)
    rows = [(ws[0][0], "u", "a"), (ws[1][0], "u", "a"), (ws[1][0], "u", "b"), (ws[0][0], "v", "c")]
    population = spark.createDataFrame([("u",)], "customer_id string")
    tx = purchases(rows)
    assert items(recommend.stacked(tx, population, ws))["u"][:3] == ["a", "a", "b"]
    assert items(recommend.stacked(tx, population, ws, dedup=True))["u"] == ["a", "b", "c"]


def test_alternates_come_from_the_window_before(spark, purchases, shelf):
    ws = windows.back_windows("2020-02-01", 7, 2)
    rows = [(ws[0][0], "u", "p")]
    rows += [(ws[1][0], "x", "p")] + [(ws[1][0], "x", "q")] * 3
    got = recommend.stacked_alternate_items(purchases(rows), shelf, ws).where("customer_id = 'u'")
    assert [r["article_id"] for r in got.orderBy("rank").collect()] == ["p", "q"]


def test_sold_recently_only(purchases):
    tx = purchases([("2020-01-01", "u", "old"), ("2020-01-30", "u", "new")])
    assert [r[0] for r in windows.sold_articles(tx, "2020-01-30", 11).collect()] == ["new"]


def test_pairs_and_popular_tail(spark, purchases):
    tx = purchases([("2020-01-30", "u", "a"), ("2020-01-30", "v", "b"), ("2020-01-30", "v", "b")])
    pairs = spark.createDataFrame([("a", "b"), ("b", "b2")], "article_id string, article_id2 string")
    population = spark.createDataFrame([("u",), ("v",), ("w",)], "customer_id string")
    got = items(recommend.last_week_pairs(tx, population, pairs, "2020-01-30"))
    assert got == {"u": ["a", "b", "b", "a"], "v": ["b", "b2", "b", "a"], "w": ["b", "a"]}
