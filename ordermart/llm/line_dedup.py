"""Line dedup (operator 13), in DataFrame functions only.

A text's lines are its parts between line feeds (a null or empty text is one empty line).  A line's key is the
line without spaces and tabs to carriage returns at its ends, A-Z lower-cased.  Keys of ``MIN_CHARS``
code points or more that are in ``MIN_DOCS`` documents or more lose all their lines except those of the
largest doc_id that holds them; the other lines stay in their order.

The lines with a long enough key are exploded with their positions and a 128-bit fingerprint of the key, and
written once: no text travels for them.  Documents are counted by a distinct count, so a line that a third of
the corpus holds spreads by (key, document) first and meets as partial counts.  The keys over the threshold are written too, so the join
of all lines with them is one of two scans: a broadcast if they are small by measure, else an equi-join of two
exchanged sides, which adaptive execution splits where a key is hot.  Each document row then gets the sorted positions that it loses, and its text is put together from
the slices between them, in a time linear in its lines.

Rows without a doc_id are one document, less than all others.  Rows with one doc_id are one document: they
count once for a key, and repeated rows lose the same lines.  An empty table gives an empty result.  Only doc_id
and text are read, whatever other columns there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.llm.text import row_key
from ordermart.session import cut_lineage

MIN_CHARS = 20
MIN_DOCS = 3
# What is stripped at a line's ends.
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line as it is compared; ``lower`` is right, and much faster, where all characters are ASCII."""
    bare = F.btrim(line, F.lit(SPACES))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def long_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line with a key of ``min_chars`` or more: _id, _th, position, the key's fingerprint (k1, k2)."""
    lines = docs.select(*row_key(), F.posexplode(split_lines(F.col("text"))).alias("position", "line"))
    return (lines.filter(F.char_length(F.btrim("line", F.lit(SPACES))) >= min_chars)
            .withColumn("key", line_key(F.col("line")))
            .select("_id", "_th", "position", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(13), "key").alias("k2")))


def common_keys(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Keys held by ``min_docs`` documents or more, and the largest id that holds each."""
    counted = lines.groupBy("k1", "k2").agg(F.countDistinct("_id").alias("n_docs"), F.max("_id").alias("keeper"))
    return counted.filter(F.col("n_docs") >= min_docs)


def without(lines: str, dropped: str) -> Column:
    """An array without the (ascending, from 0) positions in ``dropped``: the slices between them."""
    begin = f"if(k = 0, 0, {dropped}[greatest(k - 1, 0)] + 1)"
    end = f"if(k = size({dropped}), size({lines}), {dropped}[least(k, size({dropped}) - 1)])"
    return F.expr(f"flatten(transform(sequence(0, size({dropped})), k -> slice({lines}, {begin} + 1, {end} - {begin})))")


def drop_common_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per document row: doc_id, n_lines, dropped (positions of the dropped lines, ascending) and
    kept (the text of the other lines)."""
    lines = cut_lineage(long_lines(docs, min_chars), "lines")
    common = cut_lineage(common_keys(lines, min_docs).select("k1", "k2", "keeper"), "common_lines")
    dropped = (lines.join(common, ["k1", "k2"]).filter(F.col("_id") != F.col("keeper"))
               .groupBy("_id", "_th").agg(F.sort_array(F.collect_set("position")).alias("dropped")))
    texts = docs.select(*row_key(), F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = texts.join(dropped, ["_id", "_th"], "left").withColumn("lines", split_lines(F.col("text")))
    kept = F.when(F.col("dropped").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(without("lines", "dropped"), "\n"))
    return marked.select("doc_id", F.size("lines").cast("long").alias("n_lines"),
                         F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"), kept.alias("kept"))


def report(done: DataFrame) -> DataFrame:
    """The digest columns of ``drop_common_lines``."""
    return done.select("doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"),
                       F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
