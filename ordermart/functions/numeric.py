"""Numeric and flag helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermart.config import TAX_DIVISOR

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Num / den as DOUBLE, NULL when den is 0 or NULL (plain ``/`` raises under ANSI)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def any_flag(pred: Column) -> Column:
    """``MAX(CASE WHEN pred THEN 1 ELSE 0 END)`` — 1 if any row meets ``pred``."""
    return F.max(F.when(pred, F.lit(1)).otherwise(F.lit(0)))


def flag(pred: Column) -> Column:
    """``CASE WHEN pred THEN 1 ELSE 0 END``: NULL predicates give 0."""
    return F.when(pred, F.lit(1)).otherwise(F.lit(0))


def net_of_tax(c: ColumnOrName) -> Column:
    """Amount net of 18% tax, a DOUBLE division (a decimal literal would round)."""
    return _c(c).cast("double") / F.lit(TAX_DIVISOR)

