"""Exact distinct counts of a small domain as bit sets.

Each value of the domain has a code, and a group's set of values is a row of 64-bit words with a bit for each code it holds.
Words are combined by ``bit_or``, an ordinary aggregate with a map side, so sets merge: the sets of a month
are the ``bit_or`` of its days, and several distinct counts of one grouping need no copy of the rows for each
of them (as an Expand makes).  The codes are found first; a domain of more than ``limit`` values gets none, and its caller counts as Spark does.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = 64


@dataclass(frozen=True)
class Codes:
    """The codes of a column's values: ``table`` has a row (value, code) for each, ``size`` of them (``limit`` at most)."""

    column: str
    table: DataFrame
    size: int

    @property
    def words(self) -> list[str]:
        return [f"__{self.column}_{i}" for i in range(-(-self.size // WORD))]


def codes_of(df: DataFrame, column: str, limit: int) -> Codes | None:
    """Codes of the column's values, or None if it has more than ``limit``.  One value above the limit ends the look; NULL has no code."""
    seen = df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(seen) > limit:
        return None
    rows = [(value, code) for code, value in enumerate(sorted(r[0] for r in seen))]
    schema = f"value {df.schema[column].dataType.simpleString()}, code int"
    return Codes(column, df.sparkSession.createDataFrame(rows, schema), len(rows))


def with_code(df: DataFrame, codes: Codes) -> DataFrame:
    """The rows with their value's code, ``__<column>``.  The codes' table is bounded by ``limit``, hence broadcast; the rows stay where they are."""
    table = F.broadcast(codes.table.select(F.col("value").alias("__value"), F.col("code").alias(f"__{codes.column}")))
    return df.join(table, F.col(codes.column) == F.col("__value"), "left").drop("__value")


def set_of(codes: Codes) -> list[Column]:
    """Aggregates over rows of ``with_code``: a group's set, one word a column."""
    code = F.col(f"__{codes.column}")
    bit = F.expr(f"shiftleft(1L, `__{codes.column}` % {WORD})")
    return [F.bit_or(F.when(F.floor(code / WORD) == i, bit)).alias(w) for i, w in enumerate(codes.words)]


def union_of(codes: Codes) -> list[Column]:
    """Aggregates over rows that have sets: their union."""
    return [F.bit_or(w).alias(w) for w in codes.words]


def size_of(codes: Codes) -> Column:
    """How many values a set holds; words without a bit are NULL."""
    total = F.lit(0).cast("bigint")
    for w in codes.words:
        total = total + F.coalesce(F.bit_count(w), F.lit(0))
    return total
