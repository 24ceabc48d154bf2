"""Date expressions. ``as_of`` always is a parameter, so that a result can be repeated."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnLike, _col

AsOf = dt.date | str | Column | None


def day(as_of: AsOf = None) -> Column:
    """The report date: a literal, a column, or today when omitted."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def days_between(start: ColumnLike, end: ColumnLike) -> Column:
    """Whole days from start to end; times of day are dropped first."""
    return F.datediff(_col(end), _col(start)).cast("bigint")


def month_start(date: ColumnLike) -> Column:
    return F.trunc(_col(date), "MM")


def add_months(date: ColumnLike, months: int) -> Column:
    """Month shift in which the last day of a month stays the last day."""
    date = _col(date)
    moved = F.add_months(date, months)
    return F.when(date == F.last_day(date), F.last_day(moved)).otherwise(moved)


def complete_months(start: ColumnLike, end: ColumnLike) -> Column:
    """Months completed between two dates, cut towards zero."""
    start, end = _col(start), _col(end)
    step = F.when(end < start, F.lit(-1)).otherwise(F.lit(1))
    early = F.when(
        ((step == 1) & (F.day(end) < F.day(start))) | ((step == -1) & (F.day(end) > F.day(start))),
        step,
    ).otherwise(F.lit(0))
    return (month_boundaries(start, end) - early).cast("bigint")


def month_boundaries(start: ColumnLike, end: ColumnLike) -> Column:
    """Month borders crossed between two dates, whatever the days are."""
    start, end = _col(start), _col(end)
    return ((F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)).cast("bigint")


def leave_days(
    start: ColumnLike, end: ColumnLike, inclusive: bool, when_open: int | None
) -> Column:
    """Length of a leave; ``when_open`` replaces the NULL of a leave without an end date."""
    days = days_between(start, end)
    if inclusive:
        days = days + 1
    return days if when_open is None else F.coalesce(days, F.lit(when_open).cast("bigint"))


def started_years(start: ColumnLike, as_of: AsOf) -> Column:
    """Years of 365.25 days since ``start``, each started year counted."""
    return F.ceil(days_between(start, day(as_of)) * 4 / F.lit(1461)).cast("bigint")


def elapsed_seconds(start: ColumnLike, end: ColumnLike) -> Column:
    """Seconds between two timestamps, not wrapped at the minute."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)) / F.lit(1_000_000)
