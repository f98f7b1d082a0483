"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from basketry.functions.dates import date_parts
from basketry.functions.text import tokens
from basketry.operators import profile
from basketry.operators.star import star_join
from registry.base import query
from registry.fixtures import clicks, clicks_sql, documents, retail, retail_sql, table

TABLE_COLUMNS = {
    "tx": ["t_dat", "customer_id", "article_id", "price", "sales_channel_id"],
    "customers": ["customer_id", "age", "club_member_status"],
    "articles": ["article_id", "prod_name", "product_code", "product_group_name"],
}
STAR_COLUMNS = list(dict.fromkeys(c for columns in TABLE_COLUMNS.values() for c in columns))


def _nulls_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM {source}"
        for c in columns
    )


@query(
    "null_counts",
    retail_sql(
        """star AS (SELECT t.*, c.* EXCLUDE (customer_id), a.* EXCLUDE (article_id)
           FROM tx t LEFT JOIN customers c ON c.customer_id = t.customer_id
           LEFT JOIN articles a ON a.article_id = t.article_id)
        """
        + _nulls_sql("star", STAR_COLUMNS)
    ),
)
def null_counts(spark, sf_dir):
    shop = retail(spark, sf_dir)
    return profile.null_counts(star_join(shop.tx, shop.customers, shop.articles))


def _table_nulls(name):
    def run(spark, sf_dir):
        return profile.null_counts(getattr(retail(spark, sf_dir), name))

    return run


for _name, _columns in TABLE_COLUMNS.items():
    query(f"null_counts_{_name}", retail_sql(_nulls_sql(_name, _columns)))(_table_nulls(_name))


CATALOGUE_COLUMNS = ["article_id", "prod_name", "product_code", "product_group_name"]


@query(
    "distinct_counts",
    retail_sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM articles"
            for c in CATALOGUE_COLUMNS
        )
    ),
)
def distinct_counts(spark, sf_dir):
    return profile.distinct_counts(retail(spark, sf_dir).articles, CATALOGUE_COLUMNS)


def _describe_sql(column, source):
    return f"""SELECT '{column}' AS "column", count({column}) AS count, round(avg({column}), 6) AS mean,
      round(stddev_samp({column}), 6) AS std, min({column})::DOUBLE AS min,
      round(quantile_cont({column}::DOUBLE, 0.25), 6) AS q1, round(quantile_cont({column}::DOUBLE, 0.5), 6) AS q2,
      round(quantile_cont({column}::DOUBLE, 0.75), 6) AS q3, max({column})::DOUBLE AS max FROM {source}"""


@query(
    "describe",
    retail_sql(_describe_sql("price", "tx") + " UNION ALL " + _describe_sql("sales_channel_id", "tx")),
)
def describe(spark, sf_dir):
    return profile.describe(retail(spark, sf_dir).tx, ["price", "sales_channel_id"])


@query(
    "describe_customers",
    retail_sql(_describe_sql("age", "customers")),
)
def describe_customers(spark, sf_dir):
    return profile.describe(retail(spark, sf_dir).customers, ["age"])


@query(
    "value_counts",
    retail_sql("SELECT product_group_name AS value, count(*) AS n FROM articles GROUP BY 1"),
)
def value_counts(spark, sf_dir):
    return profile.value_counts(retail(spark, sf_dir).articles, "product_group_name")


@query(
    "value_counts_date",
    retail_sql("SELECT CAST(isodow(t_dat) - 1 AS INTEGER) AS value, count(*) AS n FROM tx GROUP BY 1"),
)
def value_counts_date(spark, sf_dir):
    return profile.value_counts(retail(spark, sf_dir).tx.select(*date_parts("t_dat")), "dayofweek")


@query(
    "histogram",
    retail_sql("SELECT floor(price / 250.0) * 250.0::DOUBLE AS bin_start, count(*) AS n FROM tx GROUP BY 1"),
)
def histogram(spark, sf_dir):
    return profile.histogram(retail(spark, sf_dir).tx, "price", 250.0)


@query(
    "box_stats",
    retail_sql(
        """q AS (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS q2,
                quantile_cont(price, 0.75) AS q3 FROM tx),
        fence AS (SELECT *, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM q)
        SELECT round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS q2, round(any_value(q3), 6) AS q3,
               min(price) FILTER (WHERE price BETWEEN low AND high) AS whisker_low,
               max(price) FILTER (WHERE price BETWEEN low AND high) AS whisker_high,
               count(*) FILTER (WHERE NOT price BETWEEN low AND high) AS outliers
        FROM tx, fence"""
    ),
)
def box_stats(spark, sf_dir):
    return profile.box_stats(retail(spark, sf_dir).tx, "price")


def _box_sql(column: str, source: str) -> str:
    return f"""SELECT '{column}' AS "column", round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS q2, round(any_value(q3), 6) AS q3,
      min(v) FILTER (WHERE v BETWEEN low AND high) AS whisker_low, max(v) FILTER (WHERE v BETWEEN low AND high) AS whisker_high,
      count(*) FILTER (WHERE NOT v BETWEEN low AND high) AS outliers
    FROM (SELECT CAST({column} AS DOUBLE) AS v FROM {source}) t, (
      SELECT *, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM (
        SELECT quantile_cont({column}::DOUBLE, 0.25) AS q1, quantile_cont({column}::DOUBLE, 0.5) AS q2,
               quantile_cont({column}::DOUBLE, 0.75) AS q3 FROM {source})) q"""


LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_suppkey"]


@query("box_table", " UNION ALL ".join(_box_sql(c, "lineitem") for c in LINE_NUMBERS))
def box_table(spark, sf_dir):
    return profile.box_table(table(spark, sf_dir, "lineitem"), LINE_NUMBERS)


def _overlap_sql(left, right, key):
    return f"""
l AS (SELECT DISTINCT {key} FROM {left}), r AS (SELECT DISTINCT {key} FROM {right})
SELECT count(*) FILTER (WHERE r.{key} IS NULL) AS left_only,
       count(*) FILTER (WHERE l.{key} IS NOT NULL AND r.{key} IS NOT NULL) AS both,
       count(*) FILTER (WHERE l.{key} IS NULL) AS right_only
FROM l FULL JOIN r ON r.{key} = l.{key}"""


@query(
    "key_overlap_report",
    f"""SELECT 'customer_id' AS key_name, * FROM ({retail_sql(_overlap_sql("tx", "customers", "customer_id"))})
    UNION ALL
    SELECT 'article_id' AS key_name, * FROM ({retail_sql(_overlap_sql("tx", "articles", "article_id"))})""",
)
def key_overlap_report(spark, sf_dir):
    shop = retail(spark, sf_dir)
    by_customer = profile.key_overlap(shop.tx, shop.customers, "customer_id")
    by_article = profile.key_overlap(shop.tx, shop.articles, "article_id")
    return by_customer.withColumn("key_name", F.lit("customer_id")).unionByName(
        by_article.withColumn("key_name", F.lit("article_id"))
    )


WORDS_SQL = r"""
words AS (SELECT doc_id, regexp_extract_all(lower(text), '\S+') AS w FROM documents)"""


def _ngrams_sql(n: int) -> str:
    gram = " || ' ' || ".join(f"w[i + {j}]" if j else "w[i]" for j in range(n))
    return f"""WITH {WORDS_SQL.strip()},
grams AS (SELECT {gram} AS ngram FROM (
  SELECT w, unnest(range(1, len(w) - {n} + 2)) AS i FROM words WHERE len(w) >= {n}))
SELECT ngram, count(*) AS n FROM grams GROUP BY 1 ORDER BY n DESC, ngram LIMIT 20"""


def _top_ngrams(n):
    def run(spark, sf_dir):
        return profile.top_ngrams(documents(spark, sf_dir), "text", n)

    return run


query("top_ngrams", _ngrams_sql(2))(_top_ngrams(2))
query("top_unigrams", _ngrams_sql(1))(_top_ngrams(1))
query("top_trigrams", _ngrams_sql(3))(_top_ngrams(3))


def _no_stop_words_sql() -> str | None:
    """Spark's own English list, so there is no SQL before a session has started."""
    if SparkSession.getActiveSession() is None:
        return None
    stop = ", ".join("'" + word.replace("'", "''") + "'" for word in profile.english_stop_words())
    return f"""WITH {WORDS_SQL.strip()},
spread AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM words),
kept AS (SELECT doc_id, list(word ORDER BY place) AS w FROM spread WHERE word NOT IN ({stop}) GROUP BY 1),
grams AS (SELECT w[i] || ' ' || w[i + 1] AS ngram FROM (
  SELECT w, unnest(range(1, len(w))) AS i FROM kept WHERE len(w) >= 2))
SELECT ngram, count(*) AS n FROM grams GROUP BY 1 ORDER BY n DESC, ngram LIMIT 20"""


@query("top_ngrams_no_stop_words", _no_stop_words_sql)
def top_ngrams_no_stop_words(spark, sf_dir):
    return profile.top_ngrams(
        documents(spark, sf_dir), "text", 2, stop_words=profile.english_stop_words()
    )


@query(
    "word_frequencies",
    f"""WITH {WORDS_SQL.strip()}
SELECT ngram, count(*) AS n FROM (SELECT unnest(w) AS ngram FROM words) GROUP BY 1""",
)
def word_frequencies(spark, sf_dir):
    return profile.word_frequencies(documents(spark, sf_dir), "text")


@query(
    "word_frequencies_by_lang",
    r"""SELECT lang, word, count(*) AS n FROM (
      SELECT lang, unnest(regexp_extract_all(lower(text), '\S+')) AS word FROM documents) GROUP BY 1, 2""",
)
def word_frequencies_by_lang(spark, sf_dir):
    docs = documents(spark, sf_dir)
    words = docs.select("lang", F.explode(tokens("text", lower=True)).alias("word"))
    return words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))


@query(
    "channel_article_counts",
    retail_sql("SELECT sales_channel_id, article_id, count(*) AS n FROM tx GROUP BY 1, 2"),
)
def channel_article_counts(spark, sf_dir):
    return profile.channel_article_counts(retail(spark, sf_dir).tx)


@query(
    "unmatched_keys",
    clicks_sql(
        """SELECT DISTINCT customer_id FROM tx WHERE sales_channel_id = 2 AND customer_id NOT IN (
             SELECT customer_id FROM tx WHERE sales_channel_id = 1)"""
    ),
)
def unmatched_keys(spark, sf_dir):
    tx = clicks(spark, sf_dir).tx
    return profile.unmatched(
        tx.where(F.col("sales_channel_id") == 2),
        tx.where(F.col("sales_channel_id") == 1),
        "customer_id",
    )
