"""Window operators of SURVEY §2.9, in skew-aware forms.

Rule of thumb used throughout: a window over a key whose groups are bounded by
construction (a user's months) is a plain Spark window; a window over a key that can be
hot (a customer holding a third of all orders, or the NULL customer) is rewritten as an
aggregate (partial aggregation splits hot keys map-side) joined back, or, for running
numbers, ranked in bounded segments plus per-segment offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], payload: Sequence[str],
                   descending: bool = True) -> DataFrame:
    """W1/W2, "QUALIFY ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order_by DESC) = 1".

    Expressed as ``max(struct(order_by..., payload...))`` per key: an aggregate, so a hot
    key is combined map-side instead of being sorted in one task.  Struct ordering compares
    field by field with NULL lowest, i.e. DESC NULLS LAST (ASC NULLS FIRST with
    ``descending=False``), the same as the window.  ``payload`` columns after ``order_by``
    break ties deterministically; rows tied on all of them are identical in the output.
    """
    fields = list(dict.fromkeys([*order_by, *payload]))
    best = (F.max if descending else F.min)(F.struct(*[F.col(c).alias(c) for c in fields])).alias("_best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*keys, *[F.col("_best").getField(c).alias(c) for c in payload])


def prior_value(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column],
                cols: dict[str, str | Column], offset: int = 1) -> DataFrame:
    """``LAG(col) OVER (PARTITION BY keys ORDER BY order_by)`` for several columns.
    Plain window: used on user-month series, whose partitions are bounded by months."""
    w = Window.partitionBy(*keys).orderBy(*_cols(order_by))
    return df.withColumns({name: F.lag(c, offset).over(w) for name, c in cols.items()})


def partition_total(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    """Whole-partition aggregates kept on every row (window without ORDER BY).
    Plain window: the partitions here are (user, month), bounded by the fan-out of one month."""
    w = Window.partitionBy(*keys)
    return df.withColumns({name: a.over(w) for name, a in aggs.items()})


def last_active_before(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], value: str | Column,
                       condition: Column, name: str) -> DataFrame:
    """The latest ``value`` among *earlier* rows meeting ``condition``
    (``MAX(CASE WHEN cond THEN value END) OVER (... ROWS UNBOUNDED PRECEDING AND 1 PRECEDING)``)."""
    v = F.col(value) if isinstance(value, str) else value
    w = Window.partitionBy(*keys).orderBy(*_cols(order_by)).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.max(F.when(condition, v)).over(w))


def group_aggregate(df: DataFrame, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    """A partition-wide MAX / MIN as a keyed table, to be joined back.
    Equals the window value on every row of the key (fan-out rows repeat values, which does
    not change a MAX or MIN).  Use non-NULL keys (see ``null_safe_key``) for the join back."""
    return df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()])


NULL_KEY = "\u0000"


def null_safe_key(c: str | Column) -> Column:
    """A STRING key where NULL becomes a value no cast id can take, so that the NULL group
    of a window can be joined back with a plain equi-join.  Joining a source on this key is
    the same as joining on the original (the source's keys are never this value)."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(NULL_KEY))


MIN_TS = "0001-01-01 00:00:00"


def time_segment(ts: str | Column, unit: str = "minute") -> Column:
    """Bucket of an ordering timestamp, monotone in it; NULL (sorted first) -> the smallest bucket."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.coalesce(F.date_trunc(unit, t).cast("timestamp_ntz"), F.lit(MIN_TS).cast("timestamp_ntz"))
