"""Date helpers, all built from JVM-side Spark functions (no UDF)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def period_start(today: ColumnOrName | dt.date) -> Column:
    """First day of the loaded period.  On day 1 .. 3 take the month of (today - 1 day),
    else the month of today; as only one day is subtracted this changes the month on day 1 only."""
    d = F.lit(today) if isinstance(today, dt.date) else _c(today)
    return F.when(F.dayofmonth(d) <= 3, F.trunc(F.date_sub(d, 1), "MM")).otherwise(F.trunc(d, "MM"))


def month_key(c: ColumnOrName) -> Column:
    """First day of the month, as a DATE (``date_trunc`` would give a timestamp)."""
    return F.trunc(F.to_date(_c(c)), "MM")


def year_start(c: ColumnOrName) -> Column:
    """``DATE_TRUNC(d, YEAR)`` stays a date."""
    return F.trunc(_c(c), "YEAR")


def week_monday(c: ColumnOrName) -> Column:
    """Monday of the ISO week (Spark's 'WEEK' truncation is Monday-based)."""
    return F.trunc(_c(c), "WEEK")


def week_of_year_sunday(c: ColumnOrName) -> Column:
    """``%U`` of a date: Sunday-based week number 00-53, zero padded.

    Week 1 starts on the first Sunday of the year; days before it are week 00.
    ``dayofweek`` is 1 for Sunday, so ``dayofweek - 1`` counts days since Sunday.
    """
    d = _c(c)
    n = F.floor((F.dayofyear(d) + F.lit(6) - (F.dayofweek(d) - F.lit(1))) / F.lit(7))
    return F.lpad(n.cast("string"), 2, "0")


def iso_weekday(c: ColumnOrName) -> Column:
    """Monday = 1 … Sunday = 7, as ``MOD(DAYOFWEEK + 5, 7) + 1`` (INT64)."""
    return (F.pmod(F.dayofweek(_c(c)) + F.lit(5), F.lit(7)) + F.lit(1)).cast("bigint")


def month_diff(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Number of month boundaries between two dates (not full months, not fractional)."""
    a, b = _c(later), _c(earlier)
    return (F.year(a) * 12 + F.month(a)) - (F.year(b) * 12 + F.month(b))


def month_sequence(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Array of month starts from ``start`` to ``end``; empty when start > end (Spark's
    ``sequence`` would raise) and NULL when either bound is NULL."""
    s, e = _c(start), _c(end)
    return F.when(s <= e, F.sequence(s, e, F.expr("INTERVAL 1 MONTH"))).when(
        s > e, F.array().cast("array<date>")
    )


def hour_of(c: ColumnOrName) -> Column:
    """N8 hour as INT64."""
    return F.hour(_c(c)).cast("bigint")
