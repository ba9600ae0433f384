"""Token counts by a separator scan over flat token files (operator 1).

A flat token file is nothing but little-endian unsigned 16-bit token ids, each document followed by
the end-of-document id; there is no index.  ``write_flat`` tokenises documents into such files,
``count_tokens`` reads them as fixed-size blocks, searches each block for the end id with one vector
comparison, and stitches documents over block bounds: a prefix scan over the blocks' separator counts
numbers every fragment's document, and the fragments of one number add up.

Files are written by Spark's text writer, whose line separator is the end id's two bytes, so they go to
any store that Spark writes to; they are read back as fixed-length binary records, so one large file is
split over many tasks.  Each file is filled to whole blocks with one document of padding ids.
A document may carry a header: its doc_id in five ids below 32768, so that counts find their way
back without an index or a fixed row order.

Null and empty texts have no tokens.  Repeated rows are counted each; doc_id may be null or repeated.
Only doc_id and text are read.  Empty tables give no rows.
"""

from __future__ import annotations

import base64
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermart.llm.text import pieces
from ordermart.session import scratch_path

BLOCK = 32_768  # tokens
PADDING = 65_535
HEADER = 5  # ids of a document's header: 15 bits of doc_id each, the last one's 16 marks a null
SPLITS = 1024  # splits that one step of the outer prefix scan takes


def header(doc_id: int | None) -> list[int]:
    u = (doc_id or 0) % 2**64
    return [u >> 15 * k & 32767 for k in range(HEADER - 1)] + [u >> 60 | (16 if doc_id is None else 0)]


def _tokenise(ranks_path: str, pattern: str, end: int):
    def run(batches):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        coder = tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        total = 0
        for batch in batches:
            for part in pieces(batch):
                out = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    ids = header(doc_id) + coder.encode_ordinary(text or "")
                    out.append(np.array(ids, "<u2").tobytes())
                    total += len(ids) + 1
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["ids"])
        if fill := -total % BLOCK:
            fill += BLOCK if fill == 1 else 0  # one padding id at least, then the end id
            yield pa.RecordBatch.from_arrays([pa.array([np.full(fill - 1, PADDING, "<u2").tobytes()], pa.binary())], names=["ids"])
    return run


def write_flat(docs: DataFrame, path: str, ranks_path: str, pattern: str, end: int) -> None:
    """Flat token files of the documents (doc_id, text) in the folder ``path``."""
    separator = int(end).to_bytes(2, "little").decode("latin-1")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_tokenise(ranks_path, pattern, end), "ids binary")
    rows.select(F.col("ids").cast("string").alias("value")).write.option("lineSep", separator).option("encoding", "ISO-8859-1") \
        .option("compression", "none").option("maxRecordsPerFile", 0).text(path)


def _scan(end: int, lead: int):
    """A row for each fragment: the part of one document that one block holds."""
    def run(split, records):
        for number, record in records:
            ids = np.frombuffer(record, "<u2")
            ends = np.flatnonzero(ids == end)
            begins = np.concatenate([[0], ends + 1])
            stops = np.append(ends, len(ids))
            last = len(ends)
            leads = [ids[a:min(a + lead, b)].tolist() for a, b in zip(begins, stops, strict=True)]
            for k, (a, b) in enumerate(zip(begins.tolist(), stops.tolist(), strict=True)):
                yield split, number, k, last, a, b - a, leads[k]
    return run


def fragments(spark: SparkSession, path: str, end: int, lead: int = HEADER) -> DataFrame:
    records = spark.sparkContext.newAPIHadoopFile(
        path, "org.apache.spark.input.FixedLengthBinaryInputFormat", "org.apache.hadoop.io.LongWritable", "org.apache.hadoop.io.BytesWritable",
        conf={"org.apache.spark.input.FixedLengthBinaryInputFormat.recordLength": str(2 * BLOCK)})
    return spark.createDataFrame(records.mapPartitionsWithIndex(_scan(end, lead)),
                                 "split int, block long, k int, last int, begin int, n int, lead array<int>")


def count_tokens(spark: SparkSession, path: str, end: int, lead: int = HEADER) -> DataFrame:
    """(split, block, begin, n_tokens, lead) of every document of the files in ``path``: where it begins,
    its length and its first ``lead`` ids (which count); padding is left out."""
    from ordermart.session import cut_lineage

    found = cut_lineage(fragments(spark, path, end, lead), "fragments", compression="zstd")
    blocks = found.filter("k = 0").select("split", "block", F.col("last").alias("ends"))
    own = Window.partitionBy("split").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    within = blocks.select("split", "block", F.coalesce(F.sum("ends").over(own), F.lit(0)).alias("before"))
    # outer prefix scan: over the splits of a step, then over steps
    totals = blocks.groupBy("split").agg(F.sum("ends").alias("ends")).withColumn("step", F.expr(f"split div {SPLITS}"))
    upto = lambda w: F.coalesce(F.sum("ends").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    steps = totals.groupBy("step").agg(F.sum("ends").alias("ends")).select("step", upto(Window.orderBy("step")).alias("steps_before"))
    splits = totals.withColumn("b", upto(Window.partitionBy("step").orderBy("split"))).join(steps, "step").select(
        "split", (F.col("b") + F.col("steps_before")).alias("splits_before"))
    edge = found.filter("k = 0 or k = last").join(within, ["split", "block"]).join(splits, "split").select(
        (F.col("splits_before") + F.col("before") + F.col("k")).alias("document"), F.struct("split", "block", "begin", "lead").alias("at"), "n")
    stitched = edge.groupBy("document").agg(F.sum("n").alias("n_tokens"), F.array_sort(F.collect_list("at")).alias("at")).select(
        F.col("at")[0].alias("a"), "n_tokens", F.slice(F.flatten(F.transform("at", lambda x: x["lead"])), 1, lead).alias("lead")
    ).select("a.split", "a.block", "a.begin", "n_tokens", "lead")
    inner = found.filter("k > 0 and k < last").select("split", "block", "begin", F.col("n").cast("long").alias("n_tokens"), "lead")
    # what follows the last end id of all files is empty, not a document
    return inner.unionByName(stitched.filter("n_tokens > 0")).filter(f"n_tokens = 0 or lead[0] <> {PADDING}")


def document_counts(docs: DataFrame, ranks_path: str, pattern: str, end: int) -> DataFrame:
    """doc_id and n_tokens of every document, counted in flat files written for the purpose."""
    spark = docs.sparkSession
    path = scratch_path(spark, f"tokens-{uuid.uuid4().hex[:8]}")
    write_flat(docs, path, ranks_path, pattern, end)
    counted = count_tokens(spark, path, end)
    limbs = [F.shiftleft(F.col("lead")[k].cast("long"), 15 * k) for k in range(HEADER - 1)]
    top = F.shiftleft(F.col("lead")[HEADER - 1].bitwiseAND(15).cast("long"), 60)
    doc_id = limbs[0]
    for x in [*limbs[1:], top]:
        doc_id = doc_id.bitwiseOR(x)
    return counted.select(F.when(F.col("lead")[HEADER - 1] < 16, doc_id).alias("doc_id"), (F.col("n_tokens") - HEADER).alias("n_tokens"))
