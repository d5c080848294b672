"""Date and time column expressions.

All are built-in Catalyst expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .util import as_col


def full_years_between(start, end) -> Column:
    """complete years from ``start`` to ``end``; null when either is null."""
    return F.timestamp_diff("YEAR", as_col(start).cast("timestamp_ntz"), as_col(end).cast("timestamp_ntz"))


def full_months_between(start, end) -> Column:
    """complete months from ``start`` to ``end`` (a month counts once its day is reached)."""
    return F.timestamp_diff("MONTH", as_col(start).cast("timestamp_ntz"), as_col(end).cast("timestamp_ntz"))


def days_between(end, start) -> Column:
    """``end - start`` in days, on the calendar dates of both sides."""
    return F.datediff(F.to_date(as_col(end)), F.to_date(as_col(start)))


def add_months(d, n) -> Column:
    """calendar month shift (month-end clamps as in SQL ``+ INTERVAL n MONTH``)."""
    return F.add_months(F.to_date(as_col(d)), n)


def add_days(d, n) -> Column:
    """day shift; ``n`` may be a column (``INTERVAL col DAY``)."""
    return F.date_add(F.to_date(as_col(d)), n if isinstance(n, Column) else F.lit(n))


def date_part(ts) -> Column:
    """the date of a datetime."""
    return F.to_date(as_col(ts))


def time_part(ts) -> Column:
    """the ``HH:mm:ss`` time of a datetime, as text (TIME has no Spark type)."""
    return F.date_format(as_col(ts), "HH:mm:ss")


def quarter_start(d) -> Column:
    """first day of the calendar quarter of ``d``."""
    return F.trunc(F.to_date(as_col(d)), "quarter")


def quarter_end(d) -> Column:
    """Last day of the calendar quarter of ``d``."""
    return F.date_sub(F.add_months(quarter_start(d), 3), 1)


def three_month_bucket(months) -> Column:
    """coarsen a month count to the first month of its 3-month bucket: 1, 4, 7, ..."""
    m = as_col(months)
    return (F.lit(1) + F.lit(3) * F.floor((m - F.lit(1)) / F.lit(3))).cast("long")


def greatest_date(*cols) -> Column:
    """latest of several nullable dates; nulls are skipped, all-null gives null."""
    return F.greatest(*[as_col(c) for c in cols])


def day_gap_mod(end, start, n: int) -> Column:
    """F16: day difference modulo ``n``."""
    return days_between(end, start) % F.lit(n)
