"""Left outer equi-joins, described once and applied in key order.

Physical strategy is left to Spark: AQE measures each right side at runtime and turns a
sort-merge join into a broadcast hash join only when the measured size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``; above it, sort-merge with skewed left
partitions split (``spark.sql.adaptive.skewJoin``).  Consecutive joins on the same key
reuse one partitioning of the left side, so ``enrich`` groups them by key.  No join is forced to broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


@dataclass
class JoinSpec:
    right: DataFrame
    left_on: Sequence[str]
    right_on: Sequence[str]
    # output name -> right column name (or Column over the right side)
    select: dict[str, str | Column] = field(default_factory=dict)
    how: str = "left"
    name: str = ""
    # left column whose value spreads rows with a NULL key (see ``join_one``)
    spread_nulls_by: str | None = None


class FanOutReport:
    """How many rows of each named right side repeat a key, counted while the joins run.

    A right side's rows are numbered within their key; a sort-merge join needs that exchange and sort in any case, so
    the numbers cost one pass over rows that are there.  The counts are metrics of the plan that
    carries them (``Observation``): no job is added, no row changes.  Rows with a NULL key meet nothing and aren't counted."""

    def __init__(self) -> None:
        self._seen: list[tuple[str, Observation]] = []

    def watch(self, name: str, right: DataFrame, keys: Sequence[str]) -> DataFrame:
        known = F.lit(True)
        for k in keys:
            known = known & F.col(k).isNotNull()
        again = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys)) > 1
        seen = Observation()
        self._seen.append((name, seen))
        counted = right.withColumn("__again", F.when(known, again))
        return counted.observe(seen, F.count("__again").alias("right_rows"), F.coalesce(F.sum(F.col("__again").cast("int")), F.lit(0)).alias("repeated_rows")) \
            .drop("__again")

    def rows(self) -> list[tuple[str, int, int]]:
        """(join, rows of the right side, rows that repeat a key), once the plans that hold the joins have run."""
        return [(name, seen.get["right_rows"], seen.get["repeated_rows"]) for name, seen in self._seen]


_report: ContextVar[FanOutReport | None] = ContextVar("fan_out_report", default=None)


@contextmanager
def fan_out_report() -> Iterator[FanOutReport]:
    """Joins that are planned inside count what their named right sides repeat."""
    report = FanOutReport()
    token = _report.set(report)
    try:
        yield report
    finally:
        _report.reset(token)


NULL_SPREAD_PREFIX = "\u0001"


def join_one(left: DataFrame, spec: JoinSpec) -> DataFrame:
    """``left ⟕ right ON left_on = right_on``, keeping left's key columns, adding
    ``spec.select`` under their output names.

    With ``spread_nulls_by`` (left outer joins on STRING keys), a left row with a NULL key
    joins on ``'\\u0001' || <that column>`` instead: it still matches nothing (no source key
    starts with that character), but NULL-key rows no longer hash to a single partition."""
    rkeys = [f"__rk{i}" for i in range(len(spec.right_on))]
    sel = [F.col(r).alias(k) for r, k in zip(spec.right_on, rkeys)]
    sel += [(F.col(v) if isinstance(v, str) else v).alias(n) for n, v in spec.select.items()]
    right = spec.right.select(*sel)
    if spec.name and _report.get() is not None:
        right = _report.get().watch(spec.name, right, rkeys)
    lkeys = [F.col(k) for k in spec.left_on]
    drop = list(rkeys)
    if spec.spread_nulls_by is not None and spec.how == "left":
        any_null = None
        for k in lkeys:
            any_null = k.isNull() if any_null is None else (any_null | k.isNull())
        spread = F.concat(F.lit(NULL_SPREAD_PREFIX), F.col(spec.spread_nulls_by).cast("string"))
        left = left.withColumn("__lk0", F.when(any_null, spread).otherwise(lkeys[0]))
        lkeys = [F.col("__lk0"), *lkeys[1:]]
        drop.append("__lk0")
    cond = [lk == F.col(rk) for lk, rk in zip(lkeys, rkeys)]
    return left.join(right, cond, spec.how).drop(*drop)


def enrich(left: DataFrame, specs: Sequence[JoinSpec]) -> DataFrame:
    """Apply joins in the given order (callers group them by key)."""
    for s in specs:
        left = join_one(left, s)
    return left


def meet(specs: Sequence[JoinSpec], keys: Sequence[str]) -> DataFrame:
    """Every key that one of the right sides has, left-joined to all of them: full joins, so each side is read once.  NULL keys meet nothing."""
    met = None
    for s in specs:
        right = s.right.select(*[F.col(r).alias(k) for r, k in zip(s.right_on, keys)],
                               *[(F.col(v) if isinstance(v, str) else v).alias(n) for n, v in s.select.items()])
        if s.name and _report.get() is not None:
            right = _report.get().watch(s.name, right, keys)
        right = right.dropna(subset=list(keys))
        met = right if met is None else met.join(right, list(keys), "full")
    return met


def packed(specs: Sequence[JoinSpec], needed: set[str] | None = None) -> list[JoinSpec]:
    """The joins with a right side's columns (those in ``needed``) as one struct, ``_r<i>``.

    Each join after it then copies the struct as a block of bytes, and rows stay below the number of columns up to
    which Spark generates code for them.  ``unpacked`` gives the columns again."""
    out = []
    for i, s in enumerate(specs):
        own = {n: c for n, c in s.select.items() if needed is None or n in needed}
        cols = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in own.items()]
        out.append(replace(s, select={f"_r{i}": F.struct(*cols)} if cols else {}))
    return out


def unpacked(df: DataFrame, specs: Sequence[JoinSpec], needed: set[str] | None = None) -> DataFrame:
    own = {n: F.col(f"_r{i}")[n] for i, s in enumerate(specs) for n in s.select if needed is None or n in needed}
    return df.withColumns(own).drop(*[f"_r{i}" for i in range(len(specs))])
