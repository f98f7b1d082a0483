"""Physical plans: what reaches the scan, what is shuffled, what is never there."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from basketry.operators import combine, evaluate, history, popularity, profile, related, skew, windows
from basketry.plans import recommend
from basketry.sources import tables

LAST = dt.date(2020, 1, 28)


@pytest.fixture(scope="module")
def stored(spark, purchases, tmp_path_factory):
    rows = [
        (dt.date(2020, 1, 1) + dt.timedelta(days=i % 28), f"c{i % 9}", f"a{i % 13:03d}") for i in range(200)
    ]
    path = str(tmp_path_factory.mktemp("stored") / "tx")
    purchases(rows).write.parquet(path)
    tx = spark.read.parquet(path)
    population = spark.createDataFrame([(f"c{i}",) for i in range(10)], "customer_id string")
    articles = spark.createDataFrame(
        [(f"a{i:03d}", f"n{i // 3}", i // 4) for i in range(13)],
        "article_id string, prod_name string, product_code int",
    )
    customers = spark.createDataFrame([(f"c{i}", 20 + i) for i in range(10)], "customer_id string, age int")
    return tx, population, articles, customers


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def all_plans(tx, population, articles, customers):
    ws = windows.back_windows(LAST, 7, 3)
    pairs = related.copurchase_pairs(tx, LAST)
    return {
        "top12": recommend.top12(tx, population),
        "history_fill": recommend.history_fill(tx, population, *ws[0]),
        "two_tier": recommend.two_tier(tx, population, ws[0], ws[1]),
        "three_tier": recommend.three_tier(tx, population, ws),
        "stacked": recommend.stacked(tx, population, ws),
        "stacked_alternates": recommend.stacked_alternates(tx, articles, population, ws),
        "channel_fill": recommend.channel_fill(tx, articles, population, ws),
        "trend": recommend.trend(tx, population, LAST),
        "last_week_pairs": recommend.last_week_pairs(tx, population, pairs, LAST),
        "blended": recommend.blended(tx, articles, customers, population, LAST),
        "pairs": pairs,
    }


def test_no_cross_joins_and_no_python_in_the_recommenders(stored):
    for name, df in all_plans(*stored).items():
        text = plan(df)
        for unwanted in ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas"):
            assert unwanted not in text, (name, unwanted)


def test_windows_and_columns_reach_the_scan(stored):
    tx, *_ = stored
    text = plan(history.history_items(tx, "2020-01-08", "2020-01-15"))
    assert "GreaterThanOrEqual(t_dat,2020-01-08)" in text and "LessThan(t_dat,2020-01-15)" in text
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert schema == "t_dat:date,customer_id:string,article_id:string"
    assert plan(history.stacked_history(tx, windows.back_windows(LAST, 7, 4))).count("FileScan") == 1


def test_ranks_are_cut_before_the_shuffle(stored):
    tx, *_ = stored
    text = plan(history.history_items(tx, "2020-01-01", LAST))
    partial = text.index("Partial\n") if "Partial\n" in text else text.index(", Partial")
    assert text.index("Final") < text.index("Exchange hashpartitioning(customer_id") < partial


def test_lists_reuse_the_partitioning_of_the_ranking(stored):
    """Ranking and list building share one shuffle on the customer."""
    tx, *_ = stored
    text = plan(combine.to_lists(history.history_items(tx, "2020-01-01", LAST)))
    assert text.count("Exchange hashpartitioning") == 2


def test_popular_list_needs_no_join(stored):
    tx, population, *_ = stored
    text = plan(recommend.top12(tx, population))
    assert "Join" not in text and "TakeOrderedAndProject" in text and "Subquery" in text


def test_counts_are_combined_before_the_shuffle(stored):
    tx, *_ = stored
    assert "partial_count" in plan(popularity.article_counts(tx))


def test_only_the_population_is_joined_after_the_blend(stored):
    text = plan(recommend.blended(*[stored[i] for i in (0, 2, 3, 1)], LAST))
    above = text[: text.index("max(sold")]
    assert above.count("Join") == 1 and above.count("Exchange") <= 2


def test_windows_are_told_apart_after_the_shuffle(stored):
    """Overlapping windows copy no rows: counts are shuffled once per customer, then go to their windows."""
    tx, *_ = stored
    ref = LAST - dt.timedelta(days=6)
    for number in (1, 12):
        sweep = [(ref - dt.timedelta(days=d + 1), ref) for d in range(number)]
        text = plan(evaluate.window_sweep(tx, tx.where(F.col("t_dat") >= F.lit(ref)), sweep, ref))
        generate = [m.start() for m in re.finditer(r"Generate explode\(windows", text)]
        assert len(generate) == 2
        for at in generate:
            assert "REPARTITION_BY_COL" in text[at : at + 600].split("Exchange")[1]
        assert len(re.findall(r"Exchange hashpartitioning\(customer_id", text)) <= 4


def test_bucketed_purchases_are_not_shuffled(spark, stored):
    tx, population, *_ = stored
    table = "bucketed_purchases"
    bucketed = tables.snapshot_by_customer(tx, table, 4)
    window = windows.back_windows(LAST, 7, 1)[0]
    found = recommend.history_fill(bucketed, population, *window)
    text = plan(combine.to_lists(history.history_items(bucketed, *window)))
    assert "Bucketed: true" in text and "Exchange" not in text
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, recommend.history_fill(tx, population, *window).collect()))
    spark.sql(f"DROP TABLE {table}")


def test_windows_are_read_once(stored):
    """After the one read that is written, nothing goes back to the purchases."""
    tx, population, articles, _ = stored
    source = tx.inputFiles()[0].rsplit("/", 1)[0]
    ws = windows.back_windows(LAST, 7, 3)
    for found in (recommend.channel_fill(tx, articles, population, ws), recommend.stacked_alternates(tx, articles, population, ws)):
        text = found._jdf.queryExecution().executedPlan().toString()
        assert source.removeprefix("file://") not in text and "FileScan" in text


def test_shuffles_of_the_blend_begin_with_many_partitions(spark, stored):
    text = plan(recommend.blended(*[stored[i] for i in (0, 2, 3, 1)], LAST))
    parts = [int(n) for n in re.findall(r"Exchange hashpartitioning\(.*?, (\d+)\), ENSURE", text)]
    assert parts and min(parts) >= skew.PARTITIONS > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_best_partners_need_no_sort_of_all_pairs(stored):
    tx, *_ = stored
    text = plan(related.copurchase_pairs(tx, LAST))
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_ngrams_are_no_rows_before_they_are_counted(spark, monkeypatch):
    df = spark.createDataFrame([("A b c\td  A b c",), ("İx Σ a",), ("  ",), (None,)], "text string")
    cut, plans = profile.cut_lineage, []
    monkeypatch.setattr(profile, "cut_lineage", lambda table: (plans.append(plan(table)), cut(table))[1])
    found = profile.top_ngrams(df, "text", 2, 10)
    assert len(plans) == 2 and not any("Generate" in text for text in plans)
    expected = profile.ngram_counts(df, "text", 2).orderBy(F.desc("n"), "ngram").limit(10)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    stop = ["b c"]
    assert sorted(map(tuple, profile.top_ngrams(df, "text", 2, 10, stop).collect())) == sorted(map(tuple, profile.ngram_counts(df, "text", 2, stop).collect()))
