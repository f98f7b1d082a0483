"""Dates, windows and time-decay weights."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketry.functions.keys import ColumnOrName, _col

DateLike = Column | dt.date | str


def as_date(d: DateLike) -> Column:
    """A date literal (so that filters reach the scan) or the column as given."""
    if isinstance(d, Column):
        return d
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(d))


def to_date(c: ColumnOrName, fmt: str | None = None) -> Column:
    return F.to_date(_col(c), fmt) if fmt else F.to_date(_col(c))


def date_parts(c: ColumnOrName) -> list[Column]:
    """Year, month, day and day of week (Monday = 0)."""
    d = _col(c)
    return [
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.weekday(d).alias("dayofweek"),
    ]


def day_diff(later: DateLike, earlier: ColumnOrName) -> Column:
    return F.datediff(as_date(later), _col(earlier))


def week_bucket(t_dat: ColumnOrName, last: DateLike, days: int = 7) -> Column:
    """Last day of the bucket of ``days`` days, counted back from ``last``."""
    back = (F.floor(day_diff(last, t_dat) / F.lit(days)) * days).cast("int")
    return F.date_sub(as_date(last), back)


def week_id(
    t_dat: ColumnOrName, last: DateLike, last_week: int = 104, days: int = 7
) -> Column:
    """Running week number; the bucket that ends on ``last`` is ``last_week``."""
    back = F.floor(day_diff(last, t_dat) / F.lit(days))
    return (F.lit(last_week) - back).cast("int")


def in_window(t_dat: ColumnOrName, start: DateLike, end: DateLike) -> Column:
    """Half-open ``[start, end)``."""
    t = _col(t_dat)
    return (t >= as_date(start)) & (t < as_date(end))


def window_number(
    t_dat: ColumnOrName, windows: list[tuple[DateLike, DateLike]]
) -> Column:
    """1-based number of the first window that holds the date, else null."""
    number = None
    for i, (start, end) in enumerate(windows, start=1):
        hit = in_window(t_dat, start, end)
        number = F.when(hit, i) if number is None else number.when(hit, i)
    return number


def inverse_days(days: ColumnOrName) -> Column:
    """``1 / days``; the caller's window has to end before the reference date."""
    return F.lit(1.0) / _col(days)


def exp_days(days: ColumnOrName) -> Column:
    return F.exp(-_col(days))


# Fixed values of the mixed decay curve a / sqrt(x) + b * exp(-c * x) - d.
MIXED_DECAY = {"a": 2.5e4, "b": 1.5e5, "c": 0.2, "d": 1.0e3}


def mixed_days(days: ColumnOrName) -> Column:
    """Square-root plus exponential decay, never below zero, flat up to one day."""
    x = F.greatest(F.lit(1), _col(days)).cast("double")
    curve = (
        F.lit(MIXED_DECAY["a"]) / F.sqrt(x)
        + F.lit(MIXED_DECAY["b"]) * F.exp(F.lit(-MIXED_DECAY["c"]) * x)
        - F.lit(MIXED_DECAY["d"])
    )
    return F.greatest(F.lit(0.0), curve)


DECAYS = {"inverse": inverse_days, "exp": exp_days, "mixed": mixed_days}
