"""Corpus pipeline: what a training run keeps of ``documents``, stage by stage.

Language ID drops documents without a language; the n-gram Jaccard join keeps one document of each group of
near duplicates (the least doc_id); substring dedup removes passages that repeat; decontamination cuts
benchmark passages out; BPE gives the token ids.  Every stage works on all that its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from ordermart.llm import bpe, decontaminate, language, ngram_join, substring_dedup
from ordermart.llm.text import table
from ordermart.session import cut_lineage


def language_id(spark, docs, sf_dir):
    return language.known(docs)


def near_duplicates(spark, docs, sf_dir):
    return ngram_join.representatives(docs)


def substring_repeats(spark, docs, sf_dir):
    return substring_dedup.without_repeats(docs)


def decontamination(spark, docs, sf_dir):
    return decontaminate.cut(docs, decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark")))


def bpe_tokens(spark, docs, sf_dir):
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and the decoded text's fingerprint."""
    coded = bpe.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_repeats),
    ("decontamination", decontamination),
    ("bpe", bpe_tokens),
]

#: Language ID decides by a trained model and BPE is a greedy code; SQL expresses neither.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages one after another over ``documents``, each written as Parquet and reread."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut_lineage(docs, name)
    return docs
