"""Dense month spine per key."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermart.functions.dates import month_key, month_sequence


def month_intervals(df: DataFrame, key: str, start: str, end: dt.date, floor: dt.date | None = None) -> DataFrame:
    """One row per key: the first and last month of its spine.

    All series of a key end in the same month, so their union is one interval from the earliest start: a run of
    months is kept as its two ends and expanded only where a month is read.  Keys without a start, or with none
    up to the end, disappear, as rows of an empty month array do."""
    first = F.min(month_key(start))
    if floor is not None:
        first = F.when(first.isNotNull(), F.greatest(first, F.lit(floor)))
    return (df.groupBy(key).agg(first.alias("first_month")).where(F.col("first_month") <= F.lit(end))
            .select(key, "first_month", F.lit(end).alias("last_month")))


def expand(intervals: DataFrame, key: str, month_name: str = "join_month") -> DataFrame:
    """One row per key and month of its interval."""
    return intervals.select(key, F.explode(month_sequence(F.col("first_month"), F.col("last_month"))).alias(month_name))


def fill_idle(intervals: DataFrame, active: DataFrame, key: str, month: str = "join_month", until: str | None = None) -> DataFrame:
    """The active rows within their key's interval, and a row for each other month of it with nothing but the key
    and the month.

    Intervals and active rows meet on the key; the gap after a month's last row, and the one before a key's first,
    is a run of months that is generated there.  No idle month is shuffled, and windows on the key follow without
    another exchange.  ``until``: a run of idle months stays one row, of its first month, with its last month in
    this column (an active row's own month): what sorts these rows holds no idle month of its own."""
    own = [c for c in active.columns if c not in (key, month)]
    right = active.select(F.col(key).alias("_key"), F.col(month).alias("_at"), *own)
    met = intervals.join(right, (F.col(key) == F.col("_key")) & F.col("_at").between(F.col("first_month"), F.col("last_month")), "left")
    along = Window.partitionBy(key).orderBy("_at")
    run = lambda a, b: F.coalesce(month_sequence(a, b), F.array().cast("array<date>"))
    idle = lambda months, yes: F.transform(months, lambda m: F.struct(m.alias("m"), m.alias("until"), F.lit(yes).alias("idle")))
    if until is not None:
        one = lambda a, b: F.array(F.struct(a.alias("m"), b.alias("until"), F.lit(True).alias("idle")))
        none = F.array().cast("array<struct<m:date,until:date,idle:boolean>>")
        run = lambda a, b: F.when(a <= b, one(a, b)).otherwise(none)
        idle = lambda months, yes: months
    after = F.add_months("_at", 1)
    met = met.withColumns({"_next": F.lead("_at").over(along), "_begins": F.row_number().over(along) == 1})
    nothing = F.array().cast("array<date>") if until is None else none
    at = F.array("_at") if until is None else F.array(F.struct(F.col("_at").alias("m"), F.col("_at").alias("until"), F.lit(False).alias("idle")))
    before = F.when(F.col("_begins"), run(F.col("first_month"), F.coalesce(F.add_months("_at", -1), F.col("last_month"))))
    behind = run(after, F.coalesce(F.add_months("_next", -1), F.col("last_month")))
    met = met.withColumn("_e", F.explode(F.concat(
        idle(F.coalesce(before, nothing), True),
        idle(F.when(F.col("_at").isNotNull(), at).otherwise(nothing), False),
        idle(F.when(F.col("_at").isNotNull(), behind).otherwise(nothing), True))))
    return met.select(key, F.col("_e.m").alias(month), *([F.col("_e.until").alias(until)] if until else []), *[F.when(~F.col("_e.idle"), F.col(c)).alias(c) for c in own])


def month_spine(df: DataFrame, key: str, start: str, end: dt.date | Column, floor: dt.date | None = None,
                month_name: str = "join_month") -> DataFrame:
    """One row per (key, month) from the month of ``start`` to ``end``, DISTINCT.

    ``CROSS JOIN UNNEST(GENERATE_DATE_ARRAY(...))``: rows whose array is NULL (NULL start)
    or empty (start after end) disappear.  ``floor`` (optional) starts every series no
    earlier than that month; callers use it when months before it cannot be consumed.
    With one end for all rows only the keys' intervals are shuffled, and months appear after that; with an
    end per row the months are generated per row and made distinct.
    """
    if isinstance(end, dt.date):
        return expand(month_intervals(df, key, start, end, floor), key, month_name)
    first = month_key(start)
    if floor is not None:
        first = F.greatest(first, F.lit(floor))  # NULL start stays NULL
        first = F.when(month_key(start).isNull(), F.lit(None).cast("date")).otherwise(first)
    return (df.select(F.col(key), F.explode(month_sequence(first, end)).alias(month_name))
            .distinct())
