"""Identifiers and their string forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ARTICLE_ID_LENGTH = 10
LIST_LENGTH = 12

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_key(customer_id: ColumnOrName, signed: bool = True) -> Column:
    """Integer form of the last 16 hex characters of a customer id."""
    tail = F.right(_col(customer_id), F.lit(16))
    if signed:
        return F.conv(tail, 16, -10).cast("bigint")
    return F.conv(tail, 16, 10).cast("decimal(20,0)")


def article_key(article_id: ColumnOrName) -> Column:
    """Article id without its leading zeros, as an integer."""
    return _col(article_id).cast("bigint")


def article_label(article_number: ColumnOrName) -> Column:
    """Article number as the ten-character id."""
    return F.lpad(_col(article_number).cast("string"), ARTICLE_ID_LENGTH, "0")


def product_code(article_id: ColumnOrName, variants: int = 1000) -> Column:
    """Number shared by the colour variants of one product."""
    number = _col(article_id).cast("bigint")
    return F.call_function("div", number - F.pmod(number, F.lit(variants)), F.lit(variants))


def null_default(c: ColumnOrName, default) -> Column:
    return F.coalesce(_col(c), default if isinstance(default, Column) else F.lit(default))


def ids_to_string(ids: ColumnOrName) -> Column:
    return F.array_join(_col(ids), " ")


def string_to_ids(text: ColumnOrName) -> Column:
    """Split on white space; the empty string gives an empty list."""
    return F.filter(F.split(F.trim(_col(text)), r"\s+"), lambda item: item != "")


def truncate_prediction(text: ColumnOrName, k: int = LIST_LENGTH) -> Column:
    """First ``k`` ids of a space-joined list of ten-character ids."""
    return F.substring(F.trim(_col(text)), 1, k * ARTICLE_ID_LENGTH + k - 1)


def bin_column(
    value: ColumnOrName, edges: list[int], missing_bin: int | None = 0
) -> Column:
    """Index of the right-closed interval ``(edges[i], edges[i + 1]]``.

    Values outside every interval count as missing. ``missing_bin=None`` leaves
    missing values null.
    """
    value = _col(value)
    index = None
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        inside = (value > low) & (value <= high)
        index = F.when(inside, i) if index is None else index.when(inside, i)
    return index if missing_bin is None else F.coalesce(index, F.lit(missing_bin))
