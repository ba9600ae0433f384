"""Groups too large for one task, split by their order.

A window over (key, order) puts a key's rows into one task.  Where a key holds more than ``limit`` rows, they are
dealt to slices instead: a sample of the order values gives bounds, a row's slice is the number of bounds that are
not above it, so slices are ranges of the order and rows of equal order values share one.  Windows then run
inside (key, slice), and what an earlier slice hands to the next (a count, a last row, a running maximum) is one
narrow row per slice.

The bounds are written as a table and read back, so the join that looks them up is a broadcast only when
that table's measured size is below Spark's threshold.  Keys without large groups keep slice 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermart.session import cut_lineage

SLICE = "_slice"
SAMPLES = 8  # sampled rows per slice, about
STEP = 64  # bounds are searched by every 64th first


def _on(left: str, right: str, keys: Sequence[str]) -> list[Column]:
    return [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit).select(*keys)


def bounds(df: DataFrame, hot: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int) -> DataFrame:
    """(keys, _bounds): ascending order values that cut a hot key's rows into slices of about ``limit`` rows or less."""
    some = df.where(F.pmod(F.xxhash64(*order), F.lit(max(1, limit // SAMPLES))) == 0)
    some = some.alias("d").join(hot.alias("h"), _on("d", "h", keys), "left_semi")
    ordered = some.groupBy(*keys).agg(F.array_sort(F.collect_set(F.struct(*order))).alias("_all"))
    return ordered.select(*keys, F.expr(f"filter(_all, (x, i) -> i % {SAMPLES} = {SAMPLES - 1})").alias("_bounds"))


def slice_of(order: Sequence[str]) -> Column:
    """Number of bounds up to the row's order values: first among every 64th bound, then among the 64 after it."""
    row = f"struct({', '.join(order)})"
    coarse = f"size(filter(_bounds, (b, i) -> i % {STEP} = 0 and b <= {row}))"
    fine = f"size(filter(slice(_bounds, (g - 1) * {STEP} + 1, {STEP}), b -> b <= {row}))"
    return F.expr(f"coalesce(element_at(transform(array({coarse}), g -> if(g = 0, 0, (g - 1) * {STEP} + {fine})), 1), 0)")


def sliced(df: DataFrame, keys: Sequence[str], order: Sequence[str], limit: int, cut=cut_lineage) -> DataFrame:
    """``df`` with a column ``_slice``.  ``limit`` 0: no group is split."""
    # 0 for all rows, but no constant: the planner would drop a constant from join keys, and rows dealt by (keys, slice)
    # would be dealt again
    whole = df.withColumn(SLICE, F.pmod(F.xxhash64(keys[0]), F.lit(1)).cast("int"))
    if not limit:
        return whole
    hot = hot_keys(df, keys, limit)
    if hot.isEmpty():
        return whole
    table = cut(bounds(df, hot, keys, order, limit), "bounds")
    met = df.alias("d").join(table.alias("b"), _on("d", "b", keys), "left").select("d.*", "b._bounds")
    return met.withColumn(SLICE, slice_of(order)).drop("_bounds")


def scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], lags: dict[str, str] | None = None,
         latest: dict[str, tuple[str, Column]] | None = None, limit: int = 0, cut=cut_lineage) -> DataFrame:
    """Values of the rows before, per key in an order, without one task per key.

    ``lags``: name -> column of the row before.  ``latest``: name -> (column, condition), the greatest value among
    earlier rows that meet the condition.  Inside a slice both are windows; a slice's last row and its greatest
    values are carried to the slices after it, over one row per slice."""
    lags, latest = lags or {}, latest or {}
    if not limit:  # every key is whole: nothing is carried
        whole = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({**{n: F.lag(c).over(whole) for n, c in lags.items()},
                               **{n: F.max(F.when(condition, F.col(c))).over(whole.rowsBetween(Window.unboundedPreceding, -1))
                                  for n, (c, condition) in latest.items()}})
    rows = sliced(df, keys, order, limit, cut)
    group = [*keys, SLICE]
    inside = Window.partitionBy(*group).orderBy(*order)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    most = {n: F.when(condition, F.col(c)) for n, (c, condition) in latest.items()}
    carried = F.struct(*[F.col(c).alias(n) for n, c in lags.items()]) if lags else F.lit(0)
    parts = rows.groupBy(*group).agg(F.max_by(carried, F.struct(*order)).alias("_last"), *[F.max(e).alias(n) for n, e in most.items()])
    after = Window.partitionBy(*keys).orderBy(SLICE)
    parts = parts.select(*group, F.lag("_last").over(after).alias("_last"),
                         *[F.max(n).over(after.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_before_{n}") for n in latest]) \
        .where(F.col(SLICE) > 0)
    rows = rows.withColumns({"_first": F.row_number().over(inside) == 1, **{n: F.lag(c).over(inside) for n, c in lags.items()},
                             **{n: F.max(e).over(earlier) for n, e in most.items()}})
    met = rows.alias("d").join(parts.alias("p"), _on("d", "p", group), "left").select("d.*", "p._last", *[f"p._before_{n}" for n in latest])
    met = met.withColumns({**{n: F.when(F.col("_first") & F.col("_last").isNotNull(), F.col("_last")[n]).otherwise(F.col(n)) for n in lags},
                           **{n: F.greatest(n, f"_before_{n}") for n in latest}})
    return met.drop(SLICE, "_first", "_last", *[f"_before_{n}" for n in latest])
