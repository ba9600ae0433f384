"""Fill-in-middle transformation (operator 11) with a piecewise-linear learned rank index.

A text is cut at two code points into prefix, middle and suffix, and written with sentinels in one of two
orders, or left plain.  The draws come from the hexadecimal sha256 of the seed, a colon and the decimal doc_id:
the first two numbers are the cuts, the third decides about plain, the fourth about the order.

Code points are cut in UTF-8, so a cut's rank among the code points has to become a byte offset.  A task
learns that map for the texts of a piece: segments, each a line between its first and last boundary, are halved
until no boundary is further than ``ERROR`` bytes from its line, and a residual of one byte is stored for every
boundary.  A cut is predicted by its segment's line and corrected by its residual, which is exact.
Fitting takes ``BLOCK`` bytes at a time, so a long text needs a byte a code point and little more.

Null texts are empty.  Empty texts and texts that hold a sentinel stay plain.  A null doc_id counts as an empty
one in the draw, so repeated rows, also those without an id, have equal results.  An empty table gives an empty result.
Only doc_id and text are read, whatever other columns there are; no row is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.llm.text import flat, pieces

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ERROR = 100  # bytes; residuals are of one byte
BLOCK = 1 << 20


class RankIndex:
    """Byte offset of the code point of each rank, and of the end, in UTF-8 data."""

    def __init__(self, data: np.ndarray, error: int = ERROR, block: int = BLOCK):
        ranks, offsets, runs, rises, residuals, rank = [], [], [], [], [], 0
        for begin in range(0, len(data) + 1, block):
            at = begin + np.flatnonzero((data[begin: begin + block] & 0xC0) != 0x80)
            if begin + block > len(data):
                at = np.append(at, len(data))
            if len(at):
                lo, hi, residual = fit(at, error)
                ranks.append(rank + lo)
                offsets.append(at[lo])
                runs.append(np.maximum(hi - lo, 1))
                rises.append(at[hi] - at[lo])
                residuals.append(residual)
                rank += len(at)
        self.rank, self.offset, self.run, self.rise, self.residual = map(np.concatenate, (ranks, offsets, runs, rises, residuals))

    def __call__(self, rank: np.ndarray) -> np.ndarray:
        s = np.searchsorted(self.rank, rank, "right") - 1
        return self.offset[s] + self.rise[s] * (rank - self.rank[s]) // self.run[s] + self.residual[rank]


def fit(at: np.ndarray, error: int):
    """Segments [lo, hi] of ascending offsets, both ends included, whose lines miss no offset by more than ``error``, and
    what each offset has beyond its line.  Every round halves the segments that miss one."""
    residual = np.zeros(len(at), np.int8)
    lo, hi = np.zeros(1, np.int64), np.array([len(at) - 1])
    done = []
    while len(lo):
        size = hi - lo + 1
        first = np.cumsum(size) - size
        step = np.arange(size.sum()) - np.repeat(first, size)
        line = np.repeat(at[lo], size) + np.repeat(at[hi] - at[lo], size) * step // np.repeat(np.maximum(size - 1, 1), size)
        place = step + np.repeat(lo, size)
        miss = at[place] - line
        good = np.maximum.reduceat(np.abs(miss), first) <= error
        fits = np.repeat(good, size)
        residual[place[fits]] = miss[fits]
        done.append((lo[good], hi[good]))
        lo, hi = lo[~good], hi[~good]
        half = (lo + hi) // 2
        lo, hi = np.concatenate([lo, half + 1]), np.concatenate([half, hi])
    lo, hi = map(np.concatenate, zip(*done, strict=True))
    order = np.argsort(lo)
    return lo[order], hi[order], residual


def draws(seed: str) -> list[Column]:
    """The first four numbers of 32 bits of the fingerprint of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, i, 8), 16, 10).cast("long") for i in (1, 9, 17, 25)]


def fill_in_middle(docs: DataFrame, seed: str = "1", plain: int = 10, spm: int = 20) -> DataFrame:
    """One row per document row: doc_id, n (code points), form (psm, spm or plain), prefix_chars and middle_chars (null
    if plain), output.  ``plain`` of 100 texts stay plain, ``spm`` of 100 others have the suffix first."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.char_length(text).cast("long").alias("n"),
                       *[h.alias(f"h{i}") for i, h in enumerate(draws(seed), 1)])
    held = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    form = F.when((F.col("n") == 0) | held | (F.col("h3") % 100 >= 100 - plain), "plain").when(F.col("h4") % 100 < spm, "spm").otherwise("psm")
    a, b = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    cuts = rows.select("doc_id", "n", form.alias("form"), F.least(a, b).alias("first_cut"), F.greatest(a, b).alias("second_cut"), "text")
    done = cuts.mapInArrow(_rewrite, "doc_id long, n long, form string, first_cut long, second_cut long, output string")
    moved = F.col("form") != "plain"
    return done.select("doc_id", "n", "form", F.when(moved, F.col("first_cut")).alias("prefix_chars"),
                       F.when(moved, F.col("second_cut") - F.col("first_cut")).alias("middle_chars"), "output")


def _rewrite(batches):
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    for batch in batches:
        for part in pieces(batch):
            data, off = flat(part.column("text"))
            column = {c: part.column(c).to_numpy(zero_copy_only=False) for c in ("n", "first_cut", "second_cut")}
            offset = RankIndex(data)
            start = np.cumsum(column["n"]) - column["n"]
            first, second = offset(start + column["first_cut"]), offset(start + column["second_cut"])
            raw, out = memoryview(data), []
            for form, begin, a, b, end in zip(part.column("form").to_pylist(), off[:-1].tolist(), first.tolist(), second.tolist(), off[1:].tolist(), strict=True):
                if form == "plain":
                    out.append(bytes(raw[begin:end]))
                elif form == "psm":
                    out.append(b"".join((p, raw[begin:a], s, raw[b:end], m, raw[a:b])))
                else:
                    out.append(b"".join((s, raw[b:end], p, raw[begin:a], m, raw[a:b])))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "n", "form", "first_cut", "second_cut")),
                                              pa.array(out, pa.binary()).cast(pa.string())],
                                             names=["doc_id", "n", "form", "first_cut", "second_cut", "output"])


def restore(output: Column, form: Column) -> Column:
    """The text, from an output and its form.  No text that was cut holds a sentinel, and none arises where two parts
    meet, so the sentinels found are those written."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == "plain", output).when(form == "psm", F.concat(part[1], part[3], part[2]))
            .otherwise(F.concat(part[2], part[3], part[1])))


def report(done: DataFrame) -> DataFrame:
    """The digest columns of ``fill_in_middle``."""
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
                       digest(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))
