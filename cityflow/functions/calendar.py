"""Reporting windows: explicit ``as_of`` instead of the wall clock.

Both a driver-side form (plain dates, for parameters) and a column form (for
windows computed per row, e.g. one window per order date) are given; they
agree by construction and by test.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _add_months(d: dt.date, months: int) -> dt.date:
    idx = d.year * 12 + (d.month - 1) + months
    return dt.date(idx // 12, idx % 12 + 1, 1)


def report_window(as_of: dt.date, first: int = -5, last: int = -2) -> tuple[dt.date, dt.date]:
    """First day of month ``as_of + first`` .. last day of month ``as_of + last``.

    The default is the four-month window M-5 .. M-2, both ends inclusive.
    """
    if isinstance(as_of, dt.datetime):
        as_of = as_of.date()
    start = _add_months(as_of, first)
    end = _add_months(as_of, last + 1) - dt.timedelta(days=1)
    return start, end


def rolling_window(as_of: dt.date, days: int = 30) -> tuple[dt.date, dt.date]:
    """The ``days`` calendar days ending on ``as_of`` (inclusive)."""
    if isinstance(as_of, dt.datetime):
        as_of = as_of.date()
    return as_of - dt.timedelta(days=days - 1), as_of


def window_start(as_of: Column, first: int = -5) -> Column:
    return F.trunc(F.add_months(as_of, first), "MM")


def window_end(as_of: Column, last: int = -2) -> Column:
    return F.last_day(F.add_months(as_of, last))


def day_sequence(start: Column, end: Column) -> Column:
    """Array of every date from start to end inclusive (empty if end < start)."""
    return F.when(end >= start, F.sequence(start, end, F.expr("interval 1 day"))).otherwise(
        F.array().cast("array<date>"))


def as_date_lit(d) -> Column:
    return F.lit(d.isoformat() if hasattr(d, "isoformat") else str(d)).cast("date")
