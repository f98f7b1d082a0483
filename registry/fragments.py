"""SQL fragments shared by the comparison queries. Each is one or more CTEs."""

from __future__ import annotations

ID_ORDER = "n DESC, first_dat, article_id"


def window(start, end) -> str:
    return f"t_dat >= DATE '{start}' AND t_dat < DATE '{end}'"


def bucket(last, days) -> str:
    return f"(DATE '{last}' - CAST(floor((DATE '{last}' - t_dat) / {days}.0) AS INTEGER) * {days})"


def history(name: str, start, end, k: int = 12) -> str:
    return f"""
{name} AS (
  SELECT customer_id, article_id, n, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY {ID_ORDER}) AS rank
    FROM (SELECT customer_id, article_id, count(*) AS n, min(t_dat) AS first_dat
          FROM tx WHERE {window(start, end)} GROUP BY 1, 2))
  WHERE rank <= {k})"""


def popular(name: str, start, end, ref=None, k: int = 12, where: str = "TRUE") -> str:
    ref = ref or end
    return f"""
{name} AS (
  SELECT article_id, score, row_number() OVER (ORDER BY score DESC, article_id DESC) AS rank
  FROM (SELECT article_id, round(sum(n * (1.0::DOUBLE / days)), 9) AS score
        FROM (SELECT article_id, DATE '{ref}' - t_dat AS days, count(*) AS n
              FROM tx WHERE {window(start, end)} AND {where} GROUP BY 1, 2)
        GROUP BY 1)
  QUALIFY rank <= {k})"""


def numbered(name: str, windows) -> str:
    """Rows with the number of their window."""
    cases = " ".join(
        f"WHEN {window(start, end)} THEN {i}" for i, (start, end) in enumerate(windows, start=1)
    )
    return f"""
{name} AS (
  SELECT * FROM (SELECT *, CASE {cases} END AS window_no FROM tx) WHERE window_no IS NOT NULL)"""


def cut(parts: list[str], k: int = 12, name: str = "lists") -> str:
    """Ranked lists from parts ``SELECT customer_id, article_id, sort columns s1, s2, s3``."""
    union = "\nUNION ALL\n".join(parts)
    return f"""
{name} AS (
  SELECT customer_id, article_id, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY s1, s2, s3) AS rank
    FROM ({union}))
  WHERE rank <= {k})"""


def own(table: str, part: int = 0) -> str:
    return f"SELECT customer_id, article_id, {part} AS s1, 0 AS s2, rank AS s3 FROM {table}"


def fill(table: str, part: int = 99, who: str = "population") -> str:
    return (
        f"SELECT p.customer_id, f.article_id, {part} AS s1, 0 AS s2, f.rank AS s3 "
        f"FROM {who} p CROSS JOIN {table} f"
    )


PREDICTIONS = """
SELECT customer_id, string_agg(article_id, ' ' ORDER BY rank) AS prediction
FROM lists GROUP BY customer_id"""

ALL_PREDICTIONS = """
SELECT p.customer_id, coalesce(string_agg(l.article_id, ' ' ORDER BY l.rank), '') AS prediction
FROM population p LEFT JOIN lists l ON l.customer_id = p.customer_id GROUP BY p.customer_id"""


def average_precision(valid: str, lists: str = "lists", k: int = 12) -> str:
    """``ap`` per buyer from the CTE ``lists (customer_id, article_id, rank)``."""
    return f"""
valid AS ({valid}),
bought AS (SELECT customer_id, article_id, count(*) AS n FROM valid GROUP BY 1, 2),
totals AS (SELECT customer_id, sum(n) AS n_actual FROM bought GROUP BY 1),
hits AS (
  SELECT l.customer_id, l.place,
         row_number() OVER (PARTITION BY l.customer_id ORDER BY l.place) AS hit
  FROM (SELECT customer_id, article_id, min(rank) AS place FROM {lists}
        WHERE rank <= {k} GROUP BY 1, 2) l
  JOIN bought b ON b.customer_id = l.customer_id AND b.article_id = l.article_id),
ap AS (
  SELECT t.customer_id,
         round(coalesce(g.gain, 0.0::DOUBLE) / least(t.n_actual, {k}), 9) AS ap
  FROM totals t
  LEFT JOIN (SELECT customer_id, sum(CAST(hit AS DOUBLE) / place) AS gain FROM hits GROUP BY 1) g
    ON g.customer_id = t.customer_id)"""


def best_other(
    name: str, counts: str, group_col: str, by: str = "", others: str = "articles"
) -> str:
    """For each counted article the best seller among the others of its group.

    ``counts`` has ``[by,] article_id, article_count, article_min_price``.
    """
    by_select = f"a.{by}, " if by else ""
    by_join = f"AND b.{by} = a.{by}" if by else ""
    return f"""
{name} AS (
  SELECT * FROM (
    SELECT {by_select}a.article_id, a.article_count, a.article_min_price,
           b.article_id AS other_id, b.article_count AS other_count,
           b.article_min_price AS other_min_price,
           row_number() OVER (PARTITION BY {by_select}a.article_id
                              ORDER BY b.article_count DESC, b.article_id) AS place
    FROM {counts} a
    JOIN {others} ga ON ga.article_id = a.article_id
    JOIN {others} gb ON gb.{group_col} = ga.{group_col} AND gb.article_id <> ga.article_id
    JOIN {counts} b ON b.article_id = gb.article_id {by_join})
  WHERE place = 1)"""
