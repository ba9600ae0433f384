"""Quality rules as a short-circuit cascade (operator 6).

Words are runs of bytes that are no ASCII white space.  The base counts are taken of every document:
n_words, word_chars (code points in words), n_symbols (characters of #*$%&|<>), n_dup_lines (lines
with a word that equal an earlier line) and n_repeat_words (words in 5-word windows found twice or more in
the text).  base_failed: fewer than 10 words, or more than 20 % of them in repeated windows.

Documents that pass go through a cascade of rules, each of which may reject.  On a sample every rule is
run on every document to estimate its cost (seconds a document) and selectivity (share rejected);
the rules then run in order of rejections per cost, each only on what the rules before it left.  A document is kept
if no rule rejects it, so the order changes the work, never the verdict.  The sample has about
``SAMPLE`` documents, chosen by a fingerprint; it fixes the order alone.

Null and empty texts have no words and fail the base.  Repeated rows are judged alike.  Only doc_id and text
are read; empty tables give no rows.
"""

from __future__ import annotations

import math
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.text import IS_WORD, Ranges, flat, mix, pieces, spans, word_ids

SAMPLE = 2_000
WINDOW, LEAST_WORDS, REPEAT_PERCENT = 5, 10, 20
_U = np.uint64


def byte_set(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


SYMBOLS = byte_set(b"#*$%&|<>")
UPPER = byte_set(bytes(range(0x41, 0x5B)))
LOWER_CASE = byte_set(bytes(range(0x61, 0x7B)))
LETTERS = UPPER | LOWER_CASE
LETTERS[0x80:] = True


class Block:
    """Some documents' bytes and words; rules ask for totals by document."""

    def __init__(self, part: pa.RecordBatch):
        self.data, self.off = flat(part.column("text"))
        self.begins, self.ends, self.first = spans(IS_WORD[self.data], self.off)
        self.n_words = np.diff(self.first)
        self.words = word_ids(self.data, self.begins, self.ends)

    def bytes_in(self, chars: np.ndarray) -> np.ndarray:
        """Bytes of a set, by document."""
        return self._between(chars[self.data], self.off)

    def words_with(self, chars: np.ndarray) -> np.ndarray:
        """Words that hold a byte of a set, by document."""
        sums = np.concatenate([[0], np.cumsum(chars[self.data], dtype=np.int64)])
        return self._between(sums[self.ends] > sums[self.begins], self.first)

    @staticmethod
    def _between(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[bounds[1:]] - sums[bounds[:-1]]

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """(lines with a word, those that equal an earlier one), by document."""
        n = len(self.off) - 1
        breaks = np.flatnonzero(self.data == 10)
        stops = np.sort(np.concatenate([breaks, self.off[1:]]), kind="stable")  # a document's end comes after its last break
        doc = np.searchsorted(self.off[1:], stops, "left")
        doc = np.minimum(doc, n - 1)
        begins = np.concatenate([[0], stops[:-1] + (self.data[np.minimum(stops[:-1], max(len(self.data) - 1, 0))] == 10)]) if len(self.data) else np.zeros(n, np.int64)
        begins = np.maximum(begins, self.off[:-1][doc])
        begins = np.minimum(begins, stops)
        sums = np.concatenate([[0], np.cumsum(IS_WORD[self.data], dtype=np.int64)])
        some = sums[stops] > sums[begins]
        doc, begins, stops = doc[some], begins[some], stops[some]
        key = mix(Ranges(_BYTES[self.data], 1)(begins, stops) ^ mix(doc.astype(_U) + _U(1)))
        _, one = np.unique(key, return_index=True)
        distinct = np.bincount(doc[one], minlength=n)
        total = np.bincount(doc, minlength=n)
        return total, total - distinct

    def repeated_words(self, k: int) -> np.ndarray:
        """Words in k-word windows that occur twice or more in their document."""
        count = np.maximum(self.n_words - k + 1, 0)
        doc = np.repeat(np.arange(len(count)), count)
        at = self.first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        key = mix(Ranges(self.words)(at, at + k) ^ mix(doc.astype(_U) + _U(1)))
        order = np.argsort(key)
        s = key[order]
        twin = np.zeros(len(s), bool)
        twin[1:] = s[1:] == s[:-1]
        twin[:-1] |= twin[1:]
        depth = np.zeros(len(self.words) + 1, np.int64)
        hit = at[order[twin]]
        np.add.at(depth, hit, 1)
        np.add.at(depth, hit + k, -1)
        return self._between(np.cumsum(depth[:-1]) > 0, self.first)

    def most_common_word(self) -> np.ndarray:
        doc = np.repeat(np.arange(len(self.n_words)), self.n_words)
        key, one, count = np.unique(mix(self.words ^ mix(doc.astype(_U) + _U(1))), return_index=True, return_counts=True)
        most = np.zeros(len(self.n_words), np.int64)
        np.maximum.at(most, doc[one], count)
        return most


_BYTES = mix(np.arange(11, 267, dtype=_U) * _U(0x9E3779B97F4A7C15))

#: Rules by name: whether each document of a block is rejected.
RULES = {
    "symbols": lambda b: 10 * b.bytes_in(SYMBOLS) > b.n_words,
    "repeated lines": lambda b: (lambda total, again: 2 * again > total)(*b.lines()),
    "words without letters": lambda b: 2 * b.words_with(LETTERS) < b.n_words,
    "capitals": lambda b: 2 * b.bytes_in(UPPER) > b.bytes_in(UPPER | LOWER_CASE),
    "long words": lambda b: b.bytes_in(IS_WORD) > 30 * b.n_words,
    "short words": lambda b: 2 * b.bytes_in(IS_WORD) < 3 * b.n_words,
    "one word": lambda b: 3 * b.most_common_word() > b.n_words,
}


def _trial(batches):
    for batch in batches:
        for part in pieces(batch):
            rows = []
            for name, rule in RULES.items():
                block = Block(part)
                t = time.perf_counter()
                rejected = rule(block)
                rows.append((name, part.num_rows, int(rejected.sum()), time.perf_counter() - t))
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows, strict=True)], names=["rule", "docs", "rejected", "seconds"])


def best_order(docs: DataFrame, sample: int = SAMPLE) -> list[str]:
    """The rules, those with the most rejections per second first."""
    total = docs.count()
    parts = max(1, math.ceil(total / sample))
    tried = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)) == 0).select("text").mapInArrow(
        _trial, "rule string, docs long, rejected long, seconds double").groupBy("rule").agg(
        F.sum("docs").alias("docs"), F.sum("rejected").alias("rejected"), F.sum("seconds").alias("seconds")).collect()
    gain = {r.rule: (r.rejected + 0.5) / (r.docs + 1) / max(r.seconds / r.docs, 1e-9) for r in tried if r.docs}
    return sorted(RULES, key=lambda name: -gain.get(name, 0))


JUDGED = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, rejected_by string"


def _judge(order: list[str]):
    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                b = Block(part)
                chars = (b.data & 0xC0) != 0x80
                _, dup = b.lines()
                repeat = b.repeated_words(WINDOW)
                failed = (b.n_words < LEAST_WORDS) | (100 * repeat > REPEAT_PERCENT * b.n_words)
                by = np.where(failed, "base", "").astype(object)
                live = np.flatnonzero(~failed)
                for name in order:
                    if not len(live):
                        break
                    rejected = RULES[name](b if len(live) == part.num_rows else Block(part.take(pa.array(live))))
                    by[live[rejected]] = name
                    live = live[~rejected]
                kept = by == ""
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(b.n_words), pa.array(b._between(chars & IS_WORD[b.data], b.off)), pa.array(b.bytes_in(SYMBOLS)),
                     pa.array(dup), pa.array(repeat), pa.array(failed), pa.array(kept.astype(bool)), pa.array([x or None for x in by], pa.string())],
                    names=[x.split()[0] for x in JUDGED.split(", ")])
    return run


def judge(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """One row per document row: the base counts, base_failed, kept and rejected_by."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_judge(order or best_order(rows)), JUDGED)
