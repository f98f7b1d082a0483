"""Readers and writers.

CSV is always read with a schema, so no pass over the data is spent on inference
and ids keep their leading zeros.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.sources import schema


def _aligned_csv(
    spark: SparkSession,
    path: str,
    wanted: T.StructType,
    required: tuple[str, ...],
    corrupt_column: str | None = None,
) -> DataFrame:
    """Typed columns by header name, whatever their order in the files.

    Only a header line is read here. All files must have the same header; one
    with another order of columns fails when it is read, also with
    ``corrupt_column``. Columns that the schema
    does not name follow as strings, optional columns that the files lack come
    back as nulls, and a lacking required one is an error. A value that does not
    fit its type fails the job, or, with ``corrupt_column``, leaves the line in
    that column and nulls in the others.
    """
    header = spark.read.option("header", True).csv(path).columns
    lacking = [name for name in required if name not in header]
    if lacking:
        raise ValueError(f"{path} has no column {', '.join(lacking)}")
    types = {field.name: field.dataType for field in wanted}
    layout = [T.StructField(name, types.get(name, T.StringType())) for name in header]
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if corrupt_column:
        layout.append(T.StructField(corrupt_column, T.StringType()))
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_column)
    else:
        reader = reader.option("mode", "FAILFAST")
    rows = reader.schema(T.StructType(layout)).csv(path)
    named = [
        F.col(f.name) if f.name in header else F.lit(None).cast(f.dataType).alias(f.name)
        for f in wanted
    ]
    rest = [f.name for f in layout if f.name not in types]
    return rows.select(*named, *rest)


def read_transactions_csv(
    spark: SparkSession,
    path: str,
    partitions: int | None = None,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Purchases from plain or gzipped CSV.

    A gzip file is one split, so give ``partitions`` to spread its rows for the
    work that follows. Rows are dealt out round robin: no key can make a hot
    partition here.
    """
    keys = ("t_dat", "customer_id", "article_id")
    rows = _aligned_csv(spark, path, schema.TRANSACTIONS, keys, corrupt_column)
    return rows.repartition(partitions) if partitions else rows


def read_customers_csv(
    spark: SparkSession, path: str, corrupt_column: str | None = None
) -> DataFrame:
    return _aligned_csv(spark, path, schema.CUSTOMERS, ("customer_id",), corrupt_column)


def read_articles_csv(
    spark: SparkSession, path: str, corrupt_column: str | None = None
) -> DataFrame:
    return _aligned_csv(spark, path, schema.ARTICLES, ("article_id",), corrupt_column)


def read_population(spark: SparkSession, path: str) -> DataFrame:
    """Customers who get a prediction."""
    return _aligned_csv(spark, path, schema.POPULATION, ("customer_id",)).select("customer_id")


def spread(rows: DataFrame) -> DataFrame:
    """Deal rows out to all cores when the input has fewer splits than there are cores.

    One file of one row group, or a gzip file, is read by a single task. Input
    that already splits into enough tasks is returned as it is.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows.select(*columns) if columns else rows


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Article to the article most often bought with it."""
    return spark.read.schema(schema.PAIRS).parquet(path)


def sample_customers(tx: DataFrame, fraction: float) -> DataFrame:
    """Development sample that keeps whole customers, stable between runs."""
    bucket = F.pmod(F.xxhash64("customer_id"), F.lit(10_000))
    return tx.where(bucket < F.lit(int(fraction * 10_000)))


def snapshot(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    files_per_partition: int | None = None,
    mode: str = "overwrite",
) -> DataFrame:
    """Write Parquet and read it back: a typed, restartable cut in the lineage.

    With ``partition_by`` each value becomes a folder. ``files_per_partition``
    spreads every folder over that many tasks, so that the busiest value is not
    written by one.
    """
    writer = df
    if partition_by and files_per_partition:
        rest = [c for c in df.columns if c != partition_by]
        piece = F.pmod(F.xxhash64(*rest), F.lit(files_per_partition))
        writer = df.repartition(F.col(partition_by), piece)
    out = writer.write.mode(mode)
    (out.partitionBy(partition_by) if partition_by else out).parquet(path)
    return df.sparkSession.read.parquet(path)


def snapshot_by_month(
    tx: DataFrame, path: str, files_per_month: int | None = None
) -> DataFrame:
    """Purchases in one folder per month, so that date windows skip whole folders."""
    month = F.date_format("t_dat", "yyyy-MM")
    return snapshot(
        tx.withColumn("month", month), path, "month", files_per_partition=files_per_month
    )


def snapshot_by_customer(tx: DataFrame, table: str, buckets: int, path: str | None = None) -> DataFrame:
    """Purchases as a table of the session's catalogue, bucketed and sorted by customer.

    Its files are in ``path``, or in the warehouse.

    Counting, ranking and list building per customer, and joins with another table of
    as many buckets, then need no exchange of the purchases. A bucket is one task's
    work, so choose enough of them; a customer with a large share of all rows
    makes a large bucket, for which the plain snapshot is better.
    """
    writer = tx.write.mode("overwrite").bucketBy(buckets, "customer_id").sortBy("customer_id")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return tx.sparkSession.table(table)


def update_daily_counts(tx: DataFrame, path: str) -> DataFrame:
    """Rows per (day, article) in one folder per day, brought up to date with ``tx``.

    Only the folders of the days in ``tx`` are written, each as a whole: give all
    rows of a day. A late or repeated day replaces its folder, others keep
    their files. Returns the counts of all days, ``t_dat, article_id, n``; weekly
    counts are sums of them.
    """
    daily = tx.groupBy("t_dat", "article_id").agg(F.count(F.lit(1)).alias("n"))
    spread = daily.repartition("t_dat", F.pmod(F.xxhash64("article_id"), F.lit(4)))
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("t_dat").parquet(path)
    read = tx.sparkSession.read.schema("article_id string, n long, t_dat date").parquet(path)
    return read.select("t_dat", "article_id", "n")


def write_intermediate(df: DataFrame, path: str) -> DataFrame:
    """Derived table with its keys, such as weekly sales or a popular list."""
    return snapshot(df, path)


def write_predictions(predictions: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``customer_id,prediction`` with a header, one file per partition."""
    (
        predictions.select("customer_id", "prediction")
        .write.mode(mode)
        .option("header", True)
        .csv(path)
    )
