"""A Bloom filter of the keys that a join can meet, probed where its other side is scanned.

The filter is an array of 64-bit words: each key sets ``HASHES`` bits, and the words are an ordinary aggregate
(``bit_or`` per word, combined on the map side), so its size is fixed by ``bits`` whatever the number of
keys.  It reaches the scans as a scalar subquery.  A key that is in the set always passes; of the others, one
in about 30 passes at 8 bits a key, and they are met by no row of the join.  More keys than that
only pass more rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES = 3
WORD = 64


def _positions(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), key), F.lit(bits)) for i in range(HASHES)]


def key_filter(keys: DataFrame, column: str, bits: int) -> DataFrame:
    """One row, ``words``: the filter of a column's keys.  ``bits``: a multiple of 64."""
    at = keys.select(F.explode(F.array(*_positions(F.col(column), bits))).alias("at"))
    # shiftleft(1L, n) is bit n of a word
    words = at.groupBy(F.expr(f"at div {WORD}").alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(at % {WORD} as int))")).alias("set"))
    every = keys.sparkSession.range(bits // WORD).select(F.col("id").alias("word"))
    dense = every.join(words, "word", "left").select(F.struct("word", F.coalesce("set", F.lit(0).cast("bigint")).alias("set")).alias("w"))
    return dense.agg(F.array_sort(F.collect_list("w")).alias("w")).select(F.col("w.set").alias("words"))


def may_hold(words: Column, key: Column, bits: int) -> Column:
    """False only for keys that are not in the set; NULL keys meet nothing and don't pass."""
    hit = None
    for at in _positions(key, bits):
        bit = F.getbit(F.get(words, F.floor(at / WORD).cast("int")), (at % WORD).cast("int")) == 1
        hit = bit if hit is None else hit & bit
    return key.isNotNull() & hit


def prune(df: DataFrame, column: str, words: DataFrame, bits: int) -> DataFrame:
    return df.where(may_hold(words.scalar(), F.col(column), bits))
