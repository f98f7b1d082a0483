"""Random purchases against plain Python, and results that must not depend on layout."""

from __future__ import annotations

import datetime as dt
import math
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketry.operators import combine, evaluate, history, popularity, profile, related, windows
from basketry.operators.factor import dense_ids
from basketry.operators.skew import attach_segment_list, join_totals, numbered, numbered_in_parts, positions
from basketry.plans import recommend

START = dt.date(2020, 1, 1)
LAST = dt.date(2020, 1, 28)


def random_rows(seed, n, customers, articles, hot=0.0):
    """Purchases of which a share ``hot`` belongs to one customer and one article each."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        customer = "c0" if rng.random() < hot else f"c{rng.randrange(customers)}"
        article = "a000" if rng.random() < hot else f"a{rng.randrange(articles):03d}"
        day = START + dt.timedelta(days=rng.randrange(28))
        rows.append((day, customer, article, rng.randrange(1, 9), rng.choice((1, 2))))
    return rows


def brute_pairs(rows):
    baskets = defaultdict(set)
    for day, customer, article, *_ in rows:
        baskets[customer, (LAST - day).days // 7].add(article)
    common, together = Counter(), defaultdict(Counter)
    for basket in baskets.values():
        for a in basket:
            common[a] += 1
            for b in basket:
                if a != b:
                    together[a][b] += 1
    return {
        a: min(((-n, -common[b], b) for b, n in partners.items()))
        for a, partners in together.items()
    }


@pytest.mark.parametrize("first, deeper", [(1, 2), (2, 2), (3, 4), (16, 4)])
@pytest.mark.parametrize("seed, n, customers, articles, hot", [
    (1, 400, 12, 30, 0.0),
    (2, 500, 30, 40, 0.35),
    (3, 300, 3, 60, 0.2),
])
def test_copurchase_pairs_match_brute_force(purchases, monkeypatch, first, deeper, seed, n, customers, articles, hot):
    """Also when nearly every basket takes several rounds."""
    monkeypatch.setattr(related, "FIRST_DEPTH", first)
    monkeypatch.setattr(related, "DEEPER", deeper)
    rows = random_rows(seed, n, customers, articles, hot)
    got = related.copurchase_pairs(purchases(rows), LAST).collect()
    expected = {a: (b, -n_) for a, (n_, _, b) in brute_pairs(rows).items()}
    assert {r["article_id"]: (r["article_id2"], r["n"]) for r in got} == expected


def test_tying_articles_of_equal_baskets_are_not_paired_in_full(purchases, monkeypatch):
    tried = []
    meet = related._meet

    def counted(*args):
        rows = meet(*args)
        tried.append(rows.count())
        return rows

    monkeypatch.setattr(related, "_meet", counted)
    n = 400
    rows = [(LAST - dt.timedelta(days=7 * c), f"c{c}", f"a{i:04d}") for c in range(2) for i in range(n)]
    got = {r["article_id"]: (r["article_id2"], r["n"]) for r in related.copurchase_pairs(purchases(rows), LAST).collect()}
    assert got == {f"a{i:04d}": ("a0000" if i else "a0001", 2) for i in range(n)}
    assert sum(tried) <= 3 * related.FIRST_DEPTH * n  # not n * n


@pytest.mark.parametrize("weight", [None, "w"])
def test_numbering_splits_a_hot_group(spark, weight):
    """All ids of the hot group begin alike; its rows are numbered by several tasks."""
    rng = random.Random(6)
    rows = [("hot", 1, f"0000{i:06d}") for i in range(4000)] + [(f"c{i % 90:02d}", rng.randrange(3), f"0000{i:06d}") for i in range(900)] + [(None, 0, "x"), (None, 0, "y")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, b int, v string").withColumn("w", F.pmod(F.hash("v"), F.lit(3)) + 1).repartition(6)
    order = [F.desc("b"), F.asc("v")]
    parts = numbered_in_parts(df, ["g"], order, "_within", weight).where("g = 'hot'").groupBy("_part").count().collect()
    assert len(parts) >= 4 and max(r["count"] for r in parts) < 2000
    by_group = defaultdict(list)
    for r in numbered(df, ["g"], order, weight=weight).collect():
        by_group[r["g"]].append(r)
    assert sum(map(len, by_group.values())) == len(rows)
    for members in by_group.values():
        place = 1
        for r in sorted(members, key=lambda r: (-r["b"], r["v"])):
            assert r["rank"] == place
            place += r["w"] if weight else 1


def test_numbering_of_nothing(spark):
    assert numbered(spark.createDataFrame([], "g string, v int"), ["g"], [F.asc("v")]).collect() == []


def test_positions_equal_one_long_numbering(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.5 else f"c{i % 7}", rng.randrange(50), i) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, b int, v int").withColumn("w", F.col("v") % 3 + 1)
    got = positions(df, ["g"], {"_b": -F.col("b")}, [F.asc("v")], weight="w").collect()
    by_group = defaultdict(list)
    for r in got:
        by_group[r["g"]].append(r)
    for members in by_group.values():
        place = 1
        for r in sorted(members, key=lambda r: (-r["b"], r["v"])):
            assert r["rank"] == place
            place += r["w"]


def test_dense_ids_cover_the_range(purchases):
    tx = purchases(random_rows(6, 500, 200, 50))
    ids = [r["user"] for r in dense_ids(tx, "customer_id", "user").collect()]
    assert sorted(ids) == list(range(tx.select("customer_id").distinct().count()))


def test_segment_lists_agree_with_and_without_bound(spark):
    rows = spark.createDataFrame([(f"c{i}", i % 3) for i in range(50)], "customer_id string, segment int")
    lists = spark.createDataFrame([(0, ["a"]), (1, ["b", "c"])], "segment int, items array<string>")
    bounded = attach_segment_list(rows, lists, "segment", 3)
    dealt = attach_segment_list(rows, lists, "segment")
    columns = ["customer_id", "segment", "items"]
    assert sorted(map(tuple, bounded.select(columns).collect()), key=str) == sorted(
        map(tuple, dealt.select(columns).collect()), key=str
    )


def test_hot_key_join_is_split(spark, tmp_path):
    """A key with a third of the rows must not end up in one task."""
    path = str(tmp_path / "rows")
    spark.range(1_500_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50_000).alias("k"),
        F.xxhash64("id").alias("v"),
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    totals = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in changed}
    try:
        for key, value in changed.items():
            spark.conf.set(key, value)
        joined = join_totals(rows, totals, ["k"]).agg(F.count(F.lit(1)), F.sum(F.col("v") % 7))
        assert joined.collect()[0][0] == 1_500_000
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# --- lists for everyone ------------------------------------------------------------


@pytest.fixture(scope="module")
def shop(spark, purchases):
    rows = random_rows(7, 900, 25, 40, hot=0.33)
    tx = purchases(rows)
    population = spark.createDataFrame([(f"c{i}",) for i in range(30)], "customer_id string")
    articles = spark.createDataFrame(
        [(f"a{i:03d}", f"name{i // 3}", i // 4) for i in range(45)],
        "article_id string, prod_name string, product_code int",
    )
    customers = spark.createDataFrame(
        [(f"c{i}", None if i % 5 == 0 else 10 + 3 * i) for i in range(30)], "customer_id string, age int"
    )
    return tx, population, articles, customers


def recommenders(tx, population, articles, customers):
    ref = LAST - dt.timedelta(days=6)
    ws = windows.back_windows(ref, 7, 3)
    pairs = related.copurchase_pairs(tx, LAST)
    return {
        "top12": recommend.top12(tx, population),
        "history_fill": recommend.history_fill(tx, population, *ws[0]),
        "history_fill_dedup": recommend.history_fill(tx, population, *ws[0], dedup=True),
        "two_tier": recommend.two_tier(tx, population, ws[0], ws[1]),
        "three_tier": recommend.three_tier(tx, population, ws),
        "stacked": recommend.stacked(tx, population, ws),
        "stacked_alternates": recommend.stacked_alternates(tx, articles, population, ws, factor=1),
        "channel_fill": recommend.channel_fill(tx, articles, population, ws, dedup=True),
        "trend": recommend.trend(tx, population, LAST),
        "last_week_pairs": recommend.last_week_pairs(tx, population, pairs, LAST),
        "blended": recommend.blended(tx, articles, customers, population, LAST),
    }


def test_every_list_is_short_and_everyone_has_one(shop):
    tx, population, articles, customers = shop
    everyone = {r[0] for r in population.collect()}
    for name, lists in recommenders(*shop).items():
        rows = lists.collect()
        assert len(rows) == len(everyone) and {r["customer_id"] for r in rows} == everyone, name
        assert all(len(r["items"]) <= 12 for r in rows), name
        if name in ("top12", "trend", "history_fill", "channel_fill"):
            assert all(len(r["items"]) == 12 for r in rows), name
        if name in ("history_fill_dedup", "channel_fill", "blended"):
            assert all(len(set(r["items"])) == len(r["items"]) for r in rows), name


def test_lists_do_not_depend_on_partitioning(shop):
    tx, population, articles, customers = shop
    moved = (tx.repartition(13, "price"), population.repartition(5), articles.coalesce(1), customers)
    first = {n: sorted(map(str, df.collect())) for n, df in recommenders(*shop).items()}
    second = {n: sorted(map(str, df.collect())) for n, df in recommenders(*moved).items()}
    assert first == second


def test_lists_as_predictions(shop):
    tx, population, *_ = shop
    predictions = combine.to_predictions(recommend.history_fill(tx, population, START, LAST))
    assert predictions.columns == ["customer_id", "prediction"]
    assert tuple(evaluate.submission_check(predictions, population).first()) == (0, 0, 0)


def average_precision(actual, predicted, k=12):
    hits, score, seen = 0, 0.0, set()
    for place, item in enumerate(predicted[:k], start=1):
        if item in actual and item not in seen:
            hits += 1
            score += hits / place
        seen.add(item)
    return score / min(len(actual), k)


item_lists = st.lists(st.sampled_from("abcdefgh"), max_size=15)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(item_lists.filter(bool), item_lists), min_size=1, max_size=12))
def test_average_precision_matches_the_definition(spark, people):
    bought = [(str(i), a) for i, (actual, _) in enumerate(people) for a in actual]
    listed = [(str(i), predicted) for i, (_, predicted) in enumerate(people)]
    got = evaluate.ap_at_k(
        spark.createDataFrame(bought, "customer_id string, article_id string"),
        spark.createDataFrame(listed, "customer_id string, items array<string>"),
    ).collect()
    assert {r["customer_id"]: pytest.approx(r["ap"], abs=1e-8) for r in got} == {
        str(i): average_precision(actual, predicted) for i, (actual, predicted) in enumerate(people)
    }


def reciprocal_blend(texts, weights, k):
    score = {}
    for items, weight in zip(texts, weights):
        for place, item in enumerate(items, start=1):
            score[item] = score.get(item, 0.0) + weight / place
    return [item for item, _ in sorted(score.items(), key=lambda e: -round(e[1], 9))][:k]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(item_lists, item_lists, item_lists), min_size=1, max_size=6))
def test_blend_matches_the_definition(spark, people):
    weights = [100, 10, 1]

    def table(which):
        rows = [
            (str(i), place, item)
            for i, lists in enumerate(people)
            for place, item in enumerate(lists[which], start=1)
        ]
        return spark.createDataFrame(rows, "customer_id string, rank bigint, article_id string")

    got = defaultdict(list)
    for r in combine.blend([table(0), table(1), table(2)], weights, 5).orderBy("rank").collect():
        got[r["customer_id"]].append(r["article_id"])
    assert got == {
        str(i): expected
        for i, lists in enumerate(people)
        if (expected := reciprocal_blend(lists, weights, 5))
    }


def test_sweep_equals_one_window_at_a_time(shop):
    tx, *_ = shop
    ref = LAST - dt.timedelta(days=6)
    train, valid = windows.temporal_split(tx, ref)
    sweep = [(ref - dt.timedelta(days=d), ref) for d in (3, 7, 14)]
    got = {r["window_no"]: r["map"] for r in evaluate.window_sweep(tx, valid, sweep, ref).collect()}
    buyers = valid.select("customer_id").distinct()
    for number, (start, end) in enumerate(sweep, start=1):
        lists = recommend.history_fill(tx, buyers, start, end)
        assert evaluate.map_at_k(valid, lists).first()["map"] == got[number]


def test_decayed_popularity_options(shop):
    tx, *_ = shop
    for decay in ("inverse", "exp", "mixed"):
        got = popularity.popular_items(tx, START, LAST, decay=decay).collect()
        assert len(got) == 12 and [r["rank"] for r in sorted(got, key=lambda r: r["rank"])] == list(range(1, 13))


def test_recency_forms_agree(shop):
    tx, *_ = shop
    raw = windows.customer_recency(tx, 13).groupBy("customer_id", "article_id").agg(
        F.max("t_dat").alias("last_dat")
    )
    whole = history.last_purchase_items(tx, 14)
    assert set(map(tuple, raw.collect())) == set(
        map(tuple, whole.select("customer_id", "article_id", "last_dat").collect())
    )
    cut = history.last_purchase_items(tx, 14, k=5)
    assert set(map(tuple, cut.select("customer_id", "rank", "article_id").collect())) == set(
        map(tuple, whole.where("rank <= 5").select("customer_id", "rank", "article_id").collect())
    )


def test_rank_has_no_cap(spark):
    counts = spark.range(2500).select(F.format_string("%05d", "id").alias("article_id"), (F.col("id") % 7).alias("n"))
    assert popularity.top_k_global(counts, 2000).count() == 2000
    tx = spark.range(2500).select(
        F.lit(dt.date(2020, 9, 1)).alias("t_dat"),
        F.lit("u").alias("customer_id"),
        F.format_string("%05d", "id").alias("article_id"),
    )
    assert popularity.popular_items(tx, "2020-09-01", "2020-09-02", k=2000).count() == 2000


def test_exponential_decay_keeps_the_order_of_old_sales(spark, purchases):
    rows = [("2020-08-01", f"u{i}", "often") for i in range(5)] + [("2020-08-01", "u0", "zz_once")]
    tx = purchases(rows)
    for ref in ("2020-09-15", "2021-03-01", "2022-08-01", "2026-08-01"):
        top = popularity.popular_items(tx, "2020-08-01", "2020-08-02", ref=ref, decay="exp").orderBy("rank")
        assert [r["article_id"] for r in top.collect()] == ["often", "zz_once"]


def test_exponential_decay_over_years(spark, purchases):
    """Weights of any age are ranked; none is NaN."""
    ref = dt.date(2025, 1, 1)
    days = [1, 2, 30, 365, 691, 692, 700, 720, 744, 745, 746, 800, 1200, 2000]
    tx = purchases([(ref - dt.timedelta(days=d), "u", f"a{d:04d}") for d in days] + [(ref - dt.timedelta(days=701), "u", "a0700")])
    top = popularity.popular_items(tx, "2015-01-01", ref, k=50, decay="exp").orderBy("rank").collect()
    assert [r["article_id"] for r in top] == [f"a{d:04d}" for d in days]
    for r in top:
        d = int(r["article_id"][1:])
        expected = -700 + math.log(1 + math.exp(-1)) if d == 700 else -d
        assert abs(r["log_score"] - expected) < 1e-8 and r["score"] == pytest.approx(math.exp(expected), rel=1e-6)


def test_channel_fill_takes_null_and_other_channels(spark, purchases):
    from basketry.plans import recommend

    day = "2020-09-10"
    tx = purchases([(day, "a", "x", 1.0, 1), (day, "b", "y", 1.0, 2), (day, "b", "y", 1.0, 2), (day, "c", "z", 1.0, None), (day, "c", "z", 1.0, None), (day, "d", "w", 1.0, 0), (day, "c", "z", 1.0, 0)])
    articles = spark.createDataFrame([(a, a) for a in "xyzw"], "article_id string, prod_name string")
    population = spark.createDataFrame([(c,) for c in "abcde"], "customer_id string")
    windows = [("2020-09-08", "2020-09-15"), ("2020-09-01", "2020-09-08")]
    got = {r["customer_id"]: r["items"] for r in recommend.channel_fill(tx, articles, population, windows).collect()}
    assert got["e"] == ["z", "y", "x", "w"] and got["d"][1:] == ["z", "y", "x", "w"]
    assert got["a"] == ["x", "x"] and got["b"] == ["y", "y"] and got["c"][1:] == ["z", "y", "x", "w"]


def test_describe_takes_nan_infinity_and_empty_columns(spark):
    schema = "a double, b double, c double"
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1.0, nan, None), (inf, 2.0, None), (-inf, 4.0, None), (3.0, None, None)], schema)
    rows = {r["column"]: r for r in profile.describe(df, ["a", "b", "c"]).collect()}
    assert rows["a"]["count"] == 4 and rows["a"]["max"] == inf and rows["a"]["q2"] == 2.0
    assert (rows["b"]["count"], rows["b"]["q2"], rows["b"]["max"]) == (2, 3.0, 4.0)
    assert rows["c"]["count"] == 0 and rows["c"]["q1"] is None
    assert profile.describe(df.where("false"), ["a"]).first()["count"] == 0
    assert profile.box_stats(df, "b").first()["outliers"] == 0
    assert profile.box_stats(df, "c").first()["q1"] is None


def plain_quantile(values, fraction):
    values = sorted(values)
    place = fraction * (len(values) - 1)
    low, high = values[math.floor(place)], values[math.ceil(place)]
    return low + (high - low) * (place - math.floor(place))


@pytest.mark.parametrize("bins, most, sub", [(1000, 1 << 20, 256), (4, 50, 3), (2, 1, 2)])
def test_quantiles_of_all_columns(spark, monkeypatch, bins, most, sub):
    """Also with more different values than the bins of one round can hold."""
    monkeypatch.setattr(profile, "SUB_BINS", sub)
    rng = random.Random(4)
    rows = [(rng.random(), float(rng.randrange(5)), rng.choice([None, -1.5, 7.0]), None, float(i * i % 997)) for i in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    fractions = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)
    got = {(r["column"], r["fraction"]): r["value"] for r in profile.quantile_table(df, list("abcde"), fractions, bins, most).collect()}
    expected = {}
    for i, name in enumerate("abcde"):
        values = [r[i] for r in rows if r[i] is not None]
        expected |= {(name, fraction): plain_quantile(values, fraction) for fraction in fractions if values}
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(expected[k], abs=1e-12) for k in got)


def test_profiles_read_the_table_as_often_for_many_columns(spark, tmp_path):
    rng = random.Random(4)
    names = [f"x{i}" for i in range(8)]
    spark.createDataFrame([tuple(rng.random() for _ in names) for _ in range(200)], ", ".join(f"{n} double" for n in names)).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    jobs = {}
    for run in (profile.describe, profile.box_table):
        for number in (1, 8):
            group = f"{run.__name__}{number}"
            spark.sparkContext.setJobGroup(group, group)
            assert run(df, names[:number]).count() == number
            jobs[group] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs["describe1"] == jobs["describe8"] and jobs["box_table1"] == jobs["box_table8"]


def test_distinct_counts_copy_no_rows(spark):
    rng = random.Random(4)
    day = dt.date(1969, 12, 1)
    rows = [(day + dt.timedelta(days=rng.randrange(90)), rng.choice([None, "a", "b", ""]), rng.randrange(40), rng.random() < 0.5, None) for _ in range(900)]
    df = spark.createDataFrame(rows, "d date, s string, i long, b boolean, n string")
    found = profile.distinct_counts(df, list("dsibn"))
    expected = {c: len({r[k] for r in rows} - {None}) for k, c in enumerate("dsibn")}
    assert {r["column"]: r["n_distinct"] for r in found.collect()} == expected
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in text and "bitmap_construct_agg" in text
    assert {r["n_distinct"] for r in profile.distinct_counts(df.limit(0), list("dsibn")).collect()} == {0}


@pytest.mark.parametrize("n, cells", [(1, 1 << 20), (1, 7), (2, 64), (2, 1)])
def test_top_ngrams_equal_full_counts(spark, n, cells):
    """Also with ties at the last place and cells that many n-grams share."""
    rng = random.Random(cells)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(words[min(39, int(rng.expovariate(0.12)))] for _ in range(rng.randrange(30))) for _ in range(120)]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "text string").repartition(4)
    counts = defaultdict(int)
    for t in texts:
        w = t.split()
        for i in range(len(w) - n + 1):
            counts[" ".join(w[i : i + n])] += 1
    for k in (1, 5, 20, 100_000):
        expected = sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:k]
        assert [(r["ngram"], r["n"]) for r in profile.top_ngrams(df, "text", n, k, cells=cells).collect()] == expected


def test_top_ngrams_count_only_full_cells(spark, monkeypatch):
    """Of 2001 different n-grams those of a few cells are shuffled."""
    df = spark.createDataFrame([("often " * 50 + " ".join(f"rare{i}" for i in range(2000)),)], "text string")
    counted = []
    cut = profile.cut_lineage

    def spied(table):
        written = cut(table)
        counted.append((table.columns, written.count()))
        return written

    monkeypatch.setattr(profile, "cut_lineage", spied)
    assert profile.top_ngrams(df, "text", 1, 1).collect()[0]["n"] == 50
    assert counted[1][0] == ["ngram", "n"] and counted[1][1] <= 10
    assert profile.top_ngrams(df.limit(0), "text", 1, 3).collect() == []


def test_daily_counts_are_brought_up_to_date(spark, purchases, tmp_path):
    from basketry.sources import tables

    days = [LAST - dt.timedelta(days=d) for d in range(9)]
    rng = random.Random(2)
    rows = [(d, f"c{rng.randrange(5)}", f"a{rng.randrange(6)}") for d in days for _ in range(20)]
    path = str(tmp_path / "daily")
    tables.update_daily_counts(purchases(rows), path)
    files = {f for f in (tmp_path / "daily").rglob("*.parquet") if str(days[0]) not in str(f) and str(days[3]) not in str(f)}
    late = [(days[0], "c9", "a0"), (days[0], "c9", "a9")]
    again = [r for r in rows if r[0] in (days[0], days[3])] + late
    for _ in range(2):  # adding a day twice is adding it once
        counts = tables.update_daily_counts(purchases(again), path)
    expected = popularity.weekly_article_counts(purchases(rows + late), LAST)
    assert set(map(tuple, popularity.weekly_of_daily(counts, LAST).collect())) == set(map(tuple, expected.collect()))
    assert files and all(f.exists() for f in files)
