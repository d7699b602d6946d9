"""Date helpers.  Every job takes an explicit ``as_of`` instead of reading a clock.

Bounds are computed once on the driver from ``as_of`` and enter the plan as
DATE literals, so comparisons stay simple column-vs-literal predicates that
the parquet reader can use for row-group skipping.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_date(as_of: datetime) -> date:
    return as_of.date()


def first_day_on_or_after(instant: datetime) -> date:
    """The first calendar day whose midnight is at or after ``instant``."""
    day = instant.date()
    return day if instant.time() == time(0) else day + timedelta(days=1)


def days_back_bound(as_of: datetime, days: int) -> date:
    """Lower bound for ``cast(x as date) >= as_of - n days`` (x compared at midnight).

    A date compared with an instant is taken at midnight, so with a run time
    of 10:46 the day exactly ``days`` back is excluded and the next one is
    the first included.  For a run exactly at midnight that day is included.
    """
    return first_day_on_or_after(as_of - timedelta(days=days))


def on_or_after(ts: Column, first_day: date) -> Column:
    """``cast(ts as date) >= first_day`` written as ``ts >= midnight(first_day)``.

    The DATE literal is widened to the column's timestamp type, so the
    predicate is a plain column-vs-literal comparison the parquet reader
    can use (a ``to_date(ts)`` wrapper is only sometimes unwrapped).
    """
    return ts >= F.lit(first_day)


def day_range(ts: Column, first_day: date, last_day: date) -> Column:
    """``cast(ts as date) BETWEEN first_day AND last_day`` as a half-open range on ``ts``."""
    return (ts >= F.lit(first_day)) & (ts < F.lit(last_day + timedelta(days=1)))


def year_boundaries(as_of: datetime, birth_date: Column) -> Column:
    """Number of 1-January boundaries between ``birth_date`` and ``as_of``.

    This is the calendar-year difference (2000-12-31 to 2001-01-01 is 1),
    not the number of completed years.
    """
    return F.lit(as_of.year) - F.year(birth_date)


def export_suffix(as_of: datetime, fmt: str) -> str:
    """Run-date text used in export names."""
    return as_of.strftime(fmt)


def max_ddmmyyyy_text(cond: Column, ts: Column) -> Column:
    """Aggregate: text maximum of ``dd/MM/yyyy`` over rows where ``cond`` holds.

    The text maximum orders by day of month first, then month, then year
    (31/01/2023 is "after" 02/12/2023).  Because all three fields are fixed
    width, that order equals the numeric order of dd*10^6 + MM*10^4 + yyyy,
    so the aggregate keeps one long per group instead of formatting a string
    per row, and formats only the winner.
    """
    return ddmmyyyy_text(F.max(F.when(cond, ddmmyyyy_key(ts))))


def ddmmyyyy_key(ts: Column) -> Column:
    """A number per day in the text order of ``dd/MM/yyyy``."""
    return F.dayofmonth(ts) * 1_000_000 + F.month(ts) * 10_000 + F.year(ts)


def ddmmyyyy_text(key: Column) -> Column:
    """The text of a :func:`ddmmyyyy_key`."""
    dd = F.lpad((key / 1_000_000).cast("int").cast("string"), 2, "0")
    mm = F.lpad(((key / 10_000).cast("int") % 100).cast("string"), 2, "0")
    yyyy = F.lpad((key % 10_000).cast("string"), 4, "0")
    return F.when(key.isNotNull(), F.concat_ws("/", dd, mm, yyyy))
