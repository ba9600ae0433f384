"""The operators' registered queries: (spark, sf_dir) -> DataFrame over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from ordermart.llm import (
    bpe, decontaminate, fill_middle, language, lexical_search, licences, line_dedup, ngram_join, quality, substring_dedup, suffix_dedup, token_files, warc)
from ordermart.llm.oracle import ORACLE  # noqa: F401
from ordermart.llm.text import table


def op1_token_counts(spark, sf_dir):
    return token_files.document_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, 50256)


def op2_substring_dedup(spark, sf_dir):
    done = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_bpe(spark, sf_dir):
    coded = bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op4_warc_revisits(spark, sf_dir):
    return warc.archive(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_licences(spark, sf_dir):
    """Documents as files: a source is a directory, each 64 successive ids a folder in it."""
    path = F.concat_ws("/", "source", F.expr("doc_id div 64").cast("string"), F.col("doc_id").cast("string"))
    found = licences.scan(table(spark, sf_dir, "documents"), "doc_id", path)
    return found.withColumnRenamed("id", "doc_id").withColumn("cosine", F.round("cosine", 6))


def op6_quality_rules(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents")).drop("rejected_by")


def op7_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_suffix_dedup(spark, sf_dir):
    done = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", F.greatest(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"), "kept_sha256")


def op9_decontaminate(spark, sf_dir):
    return decontaminate.report(decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op10_language_id(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents")).drop("phrases_a_letter")


def op11_fill_middle(spark, sf_dir):
    return fill_middle.report(fill_middle.fill_in_middle(table(spark, sf_dir, "documents")))


def op12_lexical_search(spark, sf_dir):
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_line_dedup(spark, sf_dir):
    return line_dedup.report(line_dedup.drop_common_lines(table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_substring_dedup, op3_bpe, op4_warc_revisits, op5_licences, op6_quality_rules, op7_ngram_join, op8_suffix_dedup, op9_decontaminate, op10_language_id,
    op11_fill_middle, op12_lexical_search, op13_line_dedup)}
