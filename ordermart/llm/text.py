"""Vectorised text helpers for tasks: Arrow string columns as flat byte arrays, words, fingerprints.

Fingerprints are polynomial sums modulo 2**64 over mixed symbols, taken from prefix sums, so the
fingerprint of any range of bytes or words costs a constant number of array operations.
"""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 4 << 20  # text bytes handled at a time inside a task (one longer text is handled whole)

_U = np.uint64
# Odd multipliers: one pair (symbol base, mixing step) per fingerprint family.
_BASE = (_U(0x9E3779B97F4A7C15), _U(0xD1342543DE82EF95))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key() -> list[Column]:
    """Columns (_id, _th) that name a document row: its id (null becomes the least long) and a
    fingerprint of its text.  Rows that agree on both are equal in all that the operators read."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("_id"),
            F.xxhash64("text").alias("_th")]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(n: int, family: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a family's base and of its inverse modulo 2**64."""
    have = _powers.get(family)
    if have is None or len(have[0]) < n:
        size = max(n, 2 * len(have[0]) if have else 1 << 16)  # grown as pieces need them
        base = int(_BASE[family])
        p = np.full(size, _BASE[family], dtype=np.uint64)
        q = np.full(size, _U(pow(base, -1, 2**64)), dtype=np.uint64)
        p[0] = q[0] = 1
        _powers[family] = have = (np.multiply.accumulate(p), np.multiply.accumulate(q))
    return have


class Ranges:
    """Fingerprints of ranges [a, b) of a symbol array."""

    def __init__(self, symbols: np.ndarray, family: int = 0):
        p, self.inverse = powers(len(symbols) + 1, family)
        self.sums = np.zeros(len(symbols) + 1, dtype=np.uint64)
        np.cumsum(symbols * p[: len(symbols)], out=self.sums[1:])

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        h = (self.sums[b] - self.sums[a]) * self.inverse[a]
        return mix(h + (b - a).astype(np.uint64) * _U(0x2545F4914F6CDD1D))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column's bytes and its n + 1 offsets, without copying; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type not in (pa.string(), pa.binary(), pa.large_string(), pa.large_binary()):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = column.type in (pa.large_string(), pa.large_binary())
    _, offsets, data = column.buffers()
    n = len(column)
    if offsets is None or n == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset: column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]: off[-1]], off - off[0]


def pieces(batch: pa.RecordBatch, column: str = "text", size: int = CHUNK_BYTES):
    """Slices of a batch with about ``size`` bytes of text each; a longer row comes alone."""
    if batch.num_rows == 0:
        return
    _, off = flat(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(off, off[begin] + size, "right")) - 1)
        yield batch.slice(begin, end - begin)
        begin = end


def release() -> None:
    """Give freed memory back to the system: the worker that runs this task is kept for the next stage's tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def spans(is_word: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every maximal run of word bytes (runs end at document ends), and for each of
    the documents given by ``off`` its first word's index (n + 1 values)."""
    n = len(is_word)
    before = np.zeros(n + 1, bool)
    after = np.zeros(n + 1, bool)
    before[1:] = is_word
    before[off] = False  # nothing precedes a document's first byte
    after[:n] = is_word
    after[off] = False
    begins = np.flatnonzero(is_word & ~before[:n])
    ends = np.flatnonzero(is_word & ~after[1:]) + 1
    return begins, ends, np.searchsorted(begins, off)


# Word separators of the contracts, as byte classes.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_WORD = np.ones(256, bool)
IS_WORD[list(SPACE_BYTES)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_SYMBOL = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_SYMBOL2 = mix(_SYMBOL + _U(0x632BE59BD9B4E019))


def word_ids(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, family: int = 0) -> np.ndarray:
    """64-bit fingerprints of words."""
    return Ranges((_SYMBOL, _SYMBOL2)[family][data], family)(begins, ends)


def string_array(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte ranges as a string column."""
    lengths = ends - begins
    off = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=off[1:])
    take = np.arange(off[-1]) + np.repeat(begins - off[:-1], lengths)
    return pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(off.tobytes()),
                                            pa.py_buffer(data[take].tobytes())).cast(pa.string())


def lists(values: pa.Array, first: np.ndarray) -> pa.Array:
    """A list column from flat values and n + 1 offsets."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), values)
