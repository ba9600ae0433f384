"""Benchmark decontamination by FM-indexes (operator 9).

Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased.  A benchmark item's
windows are its runs of 10 consecutive words; an item of fewer words, but not none, is one window.
Each task cuts its documents into shards and builds an FM-index of each: the suffix order of the
shard's word sequence, its Burrows-Wheeler transform in a wavelet tree, and suffix positions kept for
every eighth word and every document's first.  All windows are searched backward at once through
the tree's ranks, occurrences are located by stepping to a kept position, and the hits of
a document are merged into removal spans.

The benchmark is the stated query set: it reaches the tasks in blocks of a bounded number of words, one after
another: a block's hits are written and its broadcast is dropped before the next is read.  A larger benchmark takes more
passes, never a larger broadcast.  Null texts and texts without words
have no hits, items without words no windows; repeated rows are treated alike.  Of the documents
only doc_id and text are read, of the items item_id and text.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.text import LOWER, Ranges, flat, lists, pieces, row_key, spans, word_ids
from ordermart.session import cut_lineage

WINDOW = 10
SHARD_BYTES = 2 << 20
KEPT_EVERY = 8
BLOCK_WORDS = 1_000_000
IS_WORD = np.zeros(256, bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x41:0x5B] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True


class Bits:
    """A bit vector with ranks."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        packed = np.concatenate([packed, np.zeros(16 - len(packed) % 8, np.uint8)])
        self.words = packed[: len(packed) // 8 * 8].view(np.uint64)
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Set bits before position i."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


class Wavelet:
    """A wavelet tree in level order: each level holds one bit of every symbol, zeros first below."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels = []
        for bit in reversed(range(max(1, int(largest).bit_length()))):
            ones = ((symbols >> bit) & 1).astype(bool)
            self.levels.append((bit, Bits(ones), len(symbols) - int(ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before position i."""
        begin = np.zeros_like(i)
        for bit, bits, zeros in self.levels:
            one = ((symbol >> bit) & 1).astype(bool)
            a, b = bits.rank(begin), bits.rank(i)
            begin, i = np.where(one, zeros + a, begin - a), np.where(one, zeros + b, i - b)
        return i - begin

    def get(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros_like(i)
        for bit, bits, zeros in self.levels:
            one = bits.get(i).astype(bool)
            out |= one.astype(out.dtype) << bit
            r = bits.rank(i)
            i = np.where(one, zeros + r, i - r)
        return out


def suffix_order(symbols: np.ndarray, separators: int) -> np.ndarray:
    """Suffix order by doubling.  Symbols below ``separators`` occur once each, one ending each document,
    so suffixes of different documents never tie; only suffixes that still tie are sorted again."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    s = symbols[order]
    new = np.ones(n, bool)
    new[1:] = s[1:] != s[:-1]
    group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = group
    h = 1
    while True:
        single = new & np.append(new[1:], True)
        slots = np.flatnonzero(~single)
        if not len(slots):
            return order
        at = order[slots]
        low = rank[np.minimum(at + h, n - 1)]  # a tie never reaches past a document's end
        key = rank[at] * np.int64(n + 1) + low
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[slots] = at
        fresh = np.ones(len(slots), bool)
        fresh[1:] = key[1:] != key[:-1]
        new[slots] = fresh
        group = np.maximum.accumulate(np.where(fresh, slots, 0))
        rank[at] = group
        h *= 2


class Index:
    """The FM-index of a shard: word fingerprints of its documents, ``first``: n + 1 offsets."""

    def __init__(self, words: np.ndarray, first: np.ndarray):
        docs = len(first) - 1
        self.alphabet, symbol = np.unique(words, return_inverse=True)
        n = len(words) + docs
        place = np.arange(len(words)) + np.repeat(np.arange(docs), np.diff(first))  # a separator ends each document
        text = np.empty(n, np.int64)
        ends = first[1:] + np.arange(docs)
        text[ends] = np.arange(docs)
        text[place] = symbol + docs
        order = suffix_order(text, docs)
        text = np.maximum(text - docs + 1, 0)  # one separator symbol: 0
        self.tree = Wavelet(text[order - 1], len(self.alphabet))
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(self.alphabet) + 1))])
        opening = np.zeros(n, bool)
        opening[0] = True
        opening[ends[:-1] + 1] = True
        keep = opening | (np.arange(n) % KEPT_EVERY == 0)
        kept = keep[order]
        self.kept = Bits(kept)
        self.positions = order[kept]
        #: word position of each place of the text
        self.word = np.cumsum(np.concatenate([[0], text[:-1] > 0]))

    def search(self, words: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [lo, hi) of the windows words[at: at + size]."""
        found = np.searchsorted(self.alphabet, words)
        symbol = np.where(np.append(self.alphabet, 0)[found] == words, found + 1, 0) if len(self.alphabet) else np.zeros(len(words), np.int64)
        symbol[found == len(self.alphabet)] = 0
        lo, hi = np.zeros(len(at), np.int64), np.full(len(at), self.starts[-1], np.int64)
        live = np.arange(len(at))
        for t in range(1, int(size.max(initial=0)) + 1):
            live = live[(size[live] >= t) & (hi[live] > lo[live])]
            if not len(live):
                break
            c = symbol[at[live] + size[live] - t]
            known = c > 0
            hi[live[~known]] = lo[live[~known]]
            step, c = live[known], c[known]
            lo[step] = self.starts[c] + self.tree.rank(c, lo[step])
            hi[step] = self.starts[c] + self.tree.rank(c, hi[step])
            # finished windows keep their range
            live = live[size[live] > t]
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Word positions of suffix rows, by backward steps to kept positions."""
        out = np.zeros(len(rows), np.int64)
        live, row, steps = np.arange(len(rows)), rows.copy(), 0
        while len(live):
            kept = self.kept.get(row).astype(bool)
            out[live[kept]] = self.positions[self.kept.rank(row[kept])] + steps
            live, row = live[~kept], row[~kept]
            c = self.tree.get(row)
            row = self.starts[c] + self.tree.rank(c, row)
            steps += 1
        return self.word[out]


def word_arrays(part: pa.RecordBatch):
    """(word fingerprints, first words, begins, ends) of a batch; bytes are handled a chunk at a time."""
    ids, firsts, begins, ends, words, base = [], [np.zeros(1, np.int64)], [], [], 0, 0
    for p in pieces(part):
        data, off = flat(p.column("text"))
        b, e, first = spans(IS_WORD[data], off)
        ids.append(word_ids(LOWER[data], b, e))
        begins.append(b + base)
        ends.append(e + base)
        firsts.append(first[1:] + words)
        words += len(b)
        base += len(data)
    join = lambda xs, t: np.concatenate(xs) if xs else np.zeros(0, t)
    return join(ids, np.uint64), np.concatenate(firsts), join(begins, np.int64), join(ends, np.int64)


class Windows:
    """The distinct windows of some items."""

    def __init__(self, ids: list, texts: list):
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
        self.words, first, _, _ = word_arrays(batch)
        sizes = np.diff(first)
        count = np.where(sizes >= WINDOW, sizes - WINDOW + 1, np.minimum(sizes, 1))
        item = np.repeat(np.arange(len(sizes)), count)
        at = first[item] + np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)
        size = np.minimum(sizes[item], WINDOW)
        _, one, same = np.unique(Ranges(self.words)(at, at + size), return_index=True, return_inverse=True)
        self.at, self.size, self.ids = at[one], size[one], ids
        order = np.argsort(same, kind="stable")
        self.items = item[order]  # the items of window w: items[of[w]: of[w + 1]]
        self.of = np.searchsorted(same[order], np.arange(len(one) + 1))


HITS = "_id long, _th long, doc_id long, n_words long, spans array<struct<begin:int,end:int,from_byte:int,to_byte:int>>, items array<string>"


def _scan(block):
    def run(batches):
        windows = block.value
        for batch in batches:
            for part in pieces(batch, size=SHARD_BYTES):
                words, first, begins, ends = word_arrays(part)
                docs = part.num_rows
                _, off = flat(part.column("text"))
                hit = np.zeros(len(words), bool)
                pairs = np.zeros((0, 2), np.int64)
                if len(words) and len(windows.at):
                    index = Index(words, first)
                    lo, hi = index.search(windows.words, windows.at, windows.size)
                    found = np.flatnonzero(hi > lo)
                    count = (hi - lo)[found]
                    w = np.repeat(found, count)
                    at = index.locate(np.repeat(lo[found] - (np.cumsum(count) - count), count) + np.arange(count.sum()))
                    depth = np.zeros(len(words) + 1, np.int64)
                    np.add.at(depth, at, 1)
                    np.add.at(depth, at + windows.size[w], -1)
                    hit = np.cumsum(depth[:-1]) > 0
                    owner = np.searchsorted(first, at, "right") - 1
                    n = windows.of[w + 1] - windows.of[w]
                    item = windows.items[np.repeat(windows.of[w] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                    pairs = np.unique(np.stack([np.repeat(owner, n), item], axis=1), axis=0)
                opens = hit.copy()
                opens[1:] &= ~hit[:-1]
                first_hit = first[:-1][first[:-1] < len(hit)]
                opens[first_hit] = hit[first_hit]
                closes = hit.copy()
                closes[:-1] &= ~hit[1:]
                last = first[1:][first[1:] > 0] - 1
                closes[last] = hit[last]
                a, b = np.flatnonzero(opens), np.flatnonzero(closes)
                doc = np.searchsorted(first, a, "right") - 1
                runs = pa.StructArray.from_arrays(
                    [pa.array(x.astype(np.int32)) for x in (a - first[doc], b + 1 - first[doc], begins[a] - off[doc], ends[b] - off[doc])],
                    names=["begin", "end", "from_byte", "to_byte"])
                names = pa.array([windows.ids[i] for i in pairs[:, 1].tolist()], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("_th"), part.column("doc_id"), pa.array(np.diff(first)),
                     lists(runs, np.searchsorted(doc, np.arange(docs + 1))), lists(names, np.searchsorted(pairs[:, 0], np.arange(docs + 1)))],
                    names=["_id", "_th", "doc_id", "n_words", "spans", "items"])
    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row: _id, _th, doc_id, n_words, spans (merged hits: word and byte ranges)
    and items (ids of the items that occur, as strings, each once however many benchmark rows have it; a
    benchmark row without an id has spans but no name)."""
    spark = docs.sparkSession
    rows = docs.select(*row_key(), F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").filter("text is not null")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / 2 / BLOCK_WORDS))  # a word takes two characters at least, its separator included
    out = None
    for b in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        block = spark.sparkContext.broadcast(Windows([r.item_id for r in own], [r.text for r in own]))
        hits = cut_lineage(rows.mapInArrow(_scan(block), HITS), "hits")
        block.destroy()  # the next block's pass finds no other one in memory
        if out is None:
            out = hits
            continue
        # repeated rows have equal hits: one of them stands for all
        more = hits.filter("size(spans) > 0").dropDuplicates(["_id", "_th"]).select("_id", "_th", F.col("spans").alias("s"), F.col("items").alias("i"))
        out = out.join(more, ["_id", "_th"], "left").withColumn("spans", F.expr("concat(spans, coalesce(s, array()))")) \
            .withColumn("items", F.expr("array_union(items, coalesce(i, array()))")).drop("s", "i")
    return out.withColumn("items", F.array_distinct(F.array_compact("items"))).withColumn("spans", merged("spans"))


def merged(column: str):
    """Sorted disjoint spans; touching ones are joined."""
    return F.expr(f"""aggregate(array_sort({column}), cast(array() as array<struct<begin:int,end:int,from_byte:int,to_byte:int>>), (done, x) ->
        if(size(done) > 0 and element_at(done, -1).end >= x.begin,
           concat(slice(done, 1, size(done) - 1), array(named_struct('begin', element_at(done, -1).begin, 'end', greatest(element_at(done, -1).end, x.end),
               'from_byte', element_at(done, -1).from_byte, 'to_byte', greatest(element_at(done, -1).to_byte, x.to_byte)))),
           concat(done, array(x))))""")


def report(leaks: DataFrame) -> DataFrame:
    """The digest columns of ``find_leaks``."""
    hit = F.expr("cast(aggregate(spans, 0, (n, x) -> n + x.end - x.begin) as bigint)")
    return leaks.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", F.array_sort("items")).cast("binary"), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))


def cut(docs: DataFrame, leaks: DataFrame) -> DataFrame:
    """The documents without the bytes of their spans; others are unchanged."""
    spans_ = leaks.filter("size(spans) > 0").select("_id", "_th", "spans").dropDuplicates(["_id", "_th"])
    text = "row.text"
    kept = F.expr(f"""cast(aggregate(spans, named_struct('out', cast('' as binary), 'at', 0),
        (s, x) -> named_struct('out', concat(s.out, substring(cast({text} as binary), s.at + 1, x.from_byte - s.at)), 'at', x.to_byte),
        s -> concat(s.out, substring(cast({text} as binary), s.at + 1, octet_length({text}) - s.at))) as string)""")
    keyed = docs.select(F.struct("*").alias("row"), *row_key()).join(spans_, ["_id", "_th"], "left")
    whole = F.col("row").withField("text", F.when(F.col("spans").isNotNull(), kept).otherwise(F.col(text)))
    return keyed.select(whole.alias("row")).select("row.*")
