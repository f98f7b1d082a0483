"""Round trips through files."""

from __future__ import annotations

import gzip
import os

import pytest

from basketry.sources import lineage, tables

HEADER = "t_dat,customer_id,article_id,price,sales_channel_id\n"
LINES = "2020-09-01,aa,0108775015,0.05,2\n2020-09-01,aa,0108775015,0.05,2\n2020-08-31,bb,0663713001,0.03,1\n"


def test_csv_keeps_leading_zeros_and_repeats(spark, tmp_path):
    path = tmp_path / "tx.csv"
    path.write_text(HEADER + LINES)
    tx = tables.read_transactions_csv(spark, str(path))
    assert dict(tx.dtypes) == {
        "t_dat": "date",
        "customer_id": "string",
        "article_id": "string",
        "price": "double",
        "sales_channel_id": "int",
    }
    assert sorted(r["article_id"] for r in tx.collect()) == ["0108775015", "0108775015", "0663713001"]


def test_gzip_csv_is_dealt_out(spark, tmp_path):
    path = tmp_path / "tx.csv.gz"
    with gzip.open(path, "wt") as out:
        out.write(HEADER + LINES)
    tx = tables.read_transactions_csv(spark, str(path), partitions=4)
    assert tx.count() == 3 and tx.rdd.getNumPartitions() == 4
    assert tables.spread(spark.read.text(str(path))).rdd.getNumPartitions() == 8
    assert tables.spread(spark.range(0, 10, 1, 20)).rdd.getNumPartitions() == 20


def test_column_order_of_the_file_does_not_matter(spark, tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text("age,extra,customer_id\n31,x,aa\n,y,bb\n")
    customers = tables.read_customers_csv(spark, str(path))
    got = {r["customer_id"]: (r["age"], r["club_member_status"]) for r in customers.collect()}
    assert got == {"aa": (31, None), "bb": (None, None)}


def test_other_columns_are_kept(spark, tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text("age,extra,customer_id\n31,x,aa\n")
    assert tables.read_customers_csv(spark, str(path)).first()["extra"] == "x"


@pytest.mark.parametrize("corrupt_column", [None, "line"])
def test_files_with_other_column_orders_fail(spark, tmp_path, corrupt_column):
    (tmp_path / "a.csv").write_text(HEADER + LINES)
    (tmp_path / "b.csv").write_text("t_dat,article_id,customer_id,price,sales_channel_id\n2020-09-01,0108775015,aa,1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_transactions_csv(spark, str(tmp_path), corrupt_column=corrupt_column).collect()


def test_lacking_columns_and_bad_dates_fail(spark, tmp_path):
    short = tmp_path / "short.csv"
    short.write_text("t_dat,customer_id\n2020-09-01,aa\n")
    with pytest.raises(ValueError, match="article_id"):
        tables.read_transactions_csv(spark, str(short))
    bad = tmp_path / "bad.csv"
    bad.write_text(HEADER + "yesterday,aa,0108775015,0.05,2\n" + LINES)
    with pytest.raises(Exception, match="yesterday"):
        tables.read_transactions_csv(spark, str(bad)).collect()
    kept = tables.read_transactions_csv(spark, str(bad), corrupt_column="line").collect()
    assert len(kept) == 4 and [r["line"] is None for r in kept].count(False) == 1


def test_articles_csv(spark, tmp_path):
    path = tmp_path / "articles.csv"
    path.write_text('article_id,product_code,prod_name,detail_desc\n0108775015,108775,Strap top,"Soft, long"\n')
    row = tables.read_articles_csv(spark, str(path)).first()
    assert (row["article_id"], row["product_code"], row["detail_desc"]) == ("0108775015", 108775, "Soft, long")


def test_predictions_round_trip(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [("aa", "0108775015 0663713001"), ("bb", "")]
    tables.write_predictions(spark.createDataFrame(rows, "customer_id string, prediction string"), path)
    part = next(f for f in sorted(os.listdir(path)) if f.startswith("part-"))
    with open(os.path.join(path, part)) as lines:
        assert lines.readline().strip() == "customer_id,prediction"
    population = tables.read_population(spark, path)
    assert population.columns == ["customer_id"]
    assert {r[0] for r in population.collect()} == {"aa", "bb"}


def test_snapshot_by_month_skips_folders(spark, purchases, tmp_path):
    tx = purchases([("2020-08-31", "u", "a"), ("2020-09-01", "u", "a"), ("2020-09-01", "v", "b")])
    back = tables.snapshot_by_month(tx, str(tmp_path / "snap"), files_per_month=2)
    assert back.count() == 3
    plan = back.where("month = '2020-09'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_parquet_columns_and_pairs(spark, tmp_path):
    pairs = spark.createDataFrame([("a", "b")], "article_id string, article_id2 string")
    back = tables.write_intermediate(pairs, str(tmp_path / "pairs"))
    assert back.columns == pairs.columns
    assert tables.read_pairs(spark, str(tmp_path / "pairs")).first()["article_id2"] == "b"
    assert tables.read_parquet(spark, str(tmp_path / "pairs"), ["article_id"]).columns == ["article_id"]


def test_sample_keeps_whole_customers(purchases):
    tx = purchases([("2020-01-01", f"c{i % 200}", f"a{i}") for i in range(600)])
    sample = tables.sample_customers(tx, 0.25)
    kept = {r["customer_id"]: r["count"] for r in sample.groupBy("customer_id").count().collect()}
    assert 20 < len(kept) < 80 and set(kept.values()) == {3}


def test_lineage_is_cut_in_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert lineage.ensure_checkpoint_dir(spark).replace("file:", "").startswith(folder)
    cut = lineage.cut_lineage(spark.range(5).selectExpr("id * 2 as x"))
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in plan and "Range" not in plan
    assert sorted(r[0] for r in cut.collect()) == [0, 2, 4, 6, 8]


def test_cluster_without_shared_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        lineage.ensure_checkpoint_dir(Session())


def test_temporary_tables_are_deleted(spark, purchases, tmp_path):
    from basketry.operators import related
    from basketry.plans import recommend

    tx = purchases([(f"2020-09-{d:02d}", f"c{d % 3}", f"a{d % 5}") for d in range(1, 29)])
    population = spark.createDataFrame([("c0",), ("c9",)], "customer_id string")
    articles = spark.createDataFrame([(f"a{i}", f"n{i // 2}", i // 2) for i in range(5)], "article_id string, prod_name string, product_code int")
    customers = spark.createDataFrame([("c0", 30)], "customer_id string, age int")
    folder = lineage.ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    with lineage.temporary(spark):
        lists = recommend.blended(tx, articles, customers, population, "2020-09-28")
        lists.write.parquet(str(tmp_path / "lists"))
        with lineage.temporary(spark):
            related.copurchase_pairs(tx, "2020-09-28").write.parquet(str(tmp_path / "pairs"))
        assert set(os.listdir(folder)) - before
    assert set(os.listdir(folder)) == before
    assert spark.read.parquet(str(tmp_path / "lists")).count() == 2
