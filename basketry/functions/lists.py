"""Short recommendation lists as array columns.

Arrays only ever hold lists already cut to a fixed length; longer per-customer
data stays in the long form ``(customer_id, rank, article_id)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketry.functions.keys import LIST_LENGTH, ColumnOrName, _col


def empty_list() -> Column:
    return F.array().cast("array<string>")


def or_empty(ids: ColumnOrName) -> Column:
    return F.coalesce(_col(ids), empty_list())


def list_fill(
    personal: ColumnOrName,
    popular: ColumnOrName,
    k: int = LIST_LENGTH,
    dedup: bool = False,
) -> Column:
    """``personal`` followed by ``popular``, cut at ``k``."""
    joined = F.concat(or_empty(personal), or_empty(popular))
    return F.slice(F.array_distinct(joined) if dedup else joined, 1, k)


def list_stack(*lists: ColumnOrName, k: int = LIST_LENGTH, dedup: bool = False) -> Column:
    """All lists one after the other, cut at ``k``."""
    joined = F.concat(*[or_empty(ids) for ids in lists])
    return F.slice(F.array_distinct(joined) if dedup else joined, 1, k)


def list_cut(ids: ColumnOrName, k: int) -> Column:
    return F.slice(or_empty(ids), 1, k)
