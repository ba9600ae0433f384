"""Ranked lexical search by dual trees (operator 12).

Terms are runs of digits, letters and non-ASCII characters, A-Z lower-cased.  A document's coordinate for a term is
w * ((1000000000 * tf) div (1000 * tf + 8 * m)) with the term's weight w and the document's length norm m; an item's
coordinate is how often it has the term; the score is the sum of their products.  All of it but w's logarithm is in
64-bit integers, so scores are exact.

The items are the stated query set.  They reach the tasks in blocks of about ``BLOCK_WORDS`` words, so a larger
benchmark takes more passes, never a larger broadcast.  For a block:

1. every document becomes a sparse vector over the block's terms, written once; N, L and the documents of each term are
   counted over all of them;
2. the documents whose fingerprint falls into a part of about ``SEED_DOCS`` rows are searched first.  Their k-th best score
   of an item can only be beaten by more documents, so it is a floor for all;
3. every task builds a tree over the documents of each shard, ordered by their heaviest term, and walks it together with
   the tree over the items.  A node holds the largest coordinates below it, so the product of two nodes bounds
   all scores between them: where it is below the weakest k-th score of the node's items (the floor, or what the
   task has found), the whole batch of pairs is left out.  A document under an item's own node has its exact score as
   its bound.  Ties with the k-th score are kept, because a smaller doc_id may win;
4. each task has k rows an item at most; they are ranked within 64 parts of the ids first, then over the parts.

A null text has no terms; a document or item without terms is in no result and, as a document, doesn't count for N.
Each benchmark row is an item and each document row a document, repeated rows too: repeated items repeat their
results, repeated documents stand side by side in a ranking.  A null doc_id ranks before all ids of its score.
Empty tables give an empty result.  Of the documents only doc_id and text are read, of the items item_id and text.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermart.llm.text import LOWER, flat, lists, pieces, spans, word_ids
from ordermart.session import cut_lineage, drop_cut

TOP = 10
FAN = 8  # children of a node, in both trees
BLOCK_WORDS = 1_000_000
SEED_DOCS = 20_000
SHARD_DOCS = 10_000
SHARD_PAIRS = 2 << 20  # coordinates of a shard
PARTS = 64
NULL_ID = -(2**63)
IS_WORD = np.zeros(256, bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x41:0x5B] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True

VECTORS = "_id long, n long, terms array<int>, tf array<int>"
FOUND = "item int, item_id string, _id long, score long"


def words(data: np.ndarray, off: np.ndarray):
    """Lower-cased data, begin and end of every term, and each text's first term."""
    data = LOWER[data]
    return (data, *spans(IS_WORD[data], off))


class Block:
    """The items of a block: their terms by number, and a tree of coordinate maxima over them."""

    def __init__(self, ids: list, texts: list):
        data, off = flat(pa.array(texts, pa.large_string()))
        data, begins, ends, first = words(data, off)
        of = np.repeat(np.arange(len(ids)), np.diff(first))
        self.names, at, term = np.unique(word_ids(data, begins, ends), return_index=True, return_inverse=True)
        self.second = word_ids(data, begins[at], ends[at], 1)  # with the first, 128 bits name a term
        key, count = np.unique(of * len(self.names) + term, return_counts=True)
        of, term = key // max(len(self.names), 1), key % max(len(self.names), 1)
        # items of like heaviest rare terms side by side; items without terms have no place
        rare = np.bincount(term, minlength=len(self.names))
        order = np.lexsort((rare[term], of))
        has, lead = np.unique(of[order], return_index=True)
        placed = has[np.argsort(term[order][lead], kind="stable")]
        self.ids = [ids[i] for i in placed.tolist()]
        place = np.zeros(len(ids), np.int64)
        place[placed] = np.arange(len(placed))
        self.floor = np.zeros(len(placed), np.int64)
        self.weight = np.zeros(len(self.names), np.int64)
        self.documents = self.words = 0
        self.levels = []  # of (first entry of each node, terms, coordinates)
        node, size = place[of], len(placed)
        while size:
            key, back = np.unique(node * len(self.names) + term, return_inverse=True)
            most = np.zeros(len(key), np.int64)
            np.maximum.at(most, back, count)
            node, term, count = key // len(self.names), key % len(self.names), most
            self.levels.append((np.searchsorted(node, np.arange(size + 1)), term, count))
            if size == 1:
                break
            node, size = node // FAN, -(-size // FAN)

    def numbers(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray):
        """Which words are terms of the block, and the numbers of those."""
        name = word_ids(data, begins, ends)
        slot = np.minimum(np.searchsorted(self.names, name), max(len(self.names) - 1, 0))
        hit = np.flatnonzero(self.names[slot] == name) if len(self.names) else np.zeros(0, np.int64)
        hit = hit[word_ids(data, begins[hit], ends[hit], 1) == self.second[slot[hit]]]
        return hit, slot[hit]

    def coordinates(self, n: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Of the terms of documents with n words (n for each term)."""
        if 75 * int(n.max(initial=0)) * self.documents < 2**63:
            share = 75 * n * self.documents // max(self.words, 1)
        else:
            share = np.array([75 * int(x) * self.documents // self.words for x in n.tolist()], np.int64)
        return self.weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * (25 + share)))


class Documents:
    """A tree over a shard's documents: at each level the largest coordinates below a node, by term and node."""

    def __init__(self, ids: np.ndarray, of: np.ndarray, term: np.ndarray, value: np.ndarray):
        """``of``: ascending places in ``ids``.  Documents without coordinates have no place in the tree."""
        some, first = np.unique(of, return_index=True)
        most = np.maximum.reduceat(value, first) if len(of) else value
        lead = np.flatnonzero(value == np.repeat(most, np.diff(np.append(first, len(of)))))
        lead = term[lead[np.unique(of[lead], return_index=True)[1]]] if len(of) else term
        order = np.lexsort((-most, lead))
        self.ids = ids[some[order]]
        place = np.zeros(len(ids), np.int64)
        place[some[order]] = np.arange(len(order))
        size = len(order)
        key = term.astype(np.int64) * size + place[of]
        by = np.argsort(key)
        key, value = key[by], value[by]
        self.levels = [(size, key, value)]
        while size > 1:
            up = -(-size // FAN)
            key = key // size * up + key % size // FAN
            start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            key, value, size = key[start], np.maximum.reduceat(value, start), up
            self.levels.append((size, key, value))

    def bounds(self, level: int, nodes: np.ndarray, term: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The products of the given nodes with an item node's coordinates: by reading the terms' lists, or
        by looking up each term and node, whichever touches less."""
        size, key, value = self.levels[level]
        lo, hi = np.searchsorted(key, term * size), np.searchsorted(key, (term + 1) * size)
        long = hi - lo
        if long.sum() <= 4 * len(term) * len(nodes):
            at = np.repeat(lo - (np.cumsum(long) - long), long) + np.arange(long.sum())
            total = np.zeros(size, np.int64)
            np.add.at(total, key[at] % size, value[at] * np.repeat(count, long))
            return total[nodes]
        want = term[:, None] * size + nodes
        at = np.minimum(np.searchsorted(key, want), len(key) - 1)
        return (np.where(key[at] == want, value[at], 0) * count[:, None]).sum(axis=0)


class Search:
    """The best documents of each item so far."""

    def __init__(self, block: Block, top: int):
        self.block, self.top = block, top
        self.weakest = np.maximum(block.floor, 1)
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in block.ids]
        self.compared = 0

    def add(self, documents: Documents) -> None:
        self.documents = documents
        if len(documents.ids) and self.block.levels:
            self.visit(len(self.block.levels) - 1, 0, len(documents.levels) - 1, np.zeros(1, np.int64))

    def visit(self, height: int, node: int, level: int, nodes: np.ndarray) -> None:
        """Pairs of one node over the items with nodes over the documents; the taller side is split."""
        first, term, count = self.block.levels[height]
        own = slice(first[node], first[node + 1])
        self.compared += len(nodes)
        bound = self.documents.bounds(level, nodes, term[own], count[own])
        items = slice(node * FAN**height, (node + 1) * FAN**height)
        near = bound >= self.weakest[items].min()
        nodes, bound = nodes[near], bound[near]
        if not len(nodes):
            return
        if height == 0 and level == 0:
            self.offer(node, self.documents.ids[nodes], bound)
        elif height and height >= level:
            for child in range(node * FAN, min((node + 1) * FAN, len(self.block.levels[height - 1][0]) - 1)):
                self.visit(height - 1, child, level, nodes)
        else:
            below = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
            self.visit(height, node, level - 1, below[below < self.documents.levels[level - 1][0]])

    def offer(self, item: int, ids: np.ndarray, score: np.ndarray) -> None:
        ids, score = np.concatenate([self.best[item][0], ids]), np.concatenate([self.best[item][1], score])
        order = np.lexsort((ids, -score))[: self.top]
        self.best[item] = ids[order], score[order]
        if len(order) == self.top:
            self.weakest[item] = max(self.weakest[item], score[order[-1]])


def _vectors(block):
    def run(batches):
        own = block.value
        for batch in batches:
            for part in pieces(batch):
                data, off = flat(part.column("text"))
                data, begins, ends, first = words(data, off)
                hit, number = own.numbers(data, begins, ends)
                doc = np.searchsorted(first, hit, "right") - 1
                key, tf = np.unique(doc * max(len(own.names), 1) + number, return_counts=True)
                of, term = key // max(len(own.names), 1), key % max(len(own.names), 1)
                first_of = np.searchsorted(of, np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), pa.array(np.diff(first)), lists(pa.array(term.astype(np.int32)), first_of), lists(pa.array(tf.astype(np.int32)), first_of)],
                    names=["_id", "n", "terms", "tf"])
    return run


def _shards(batch):
    """Slices of a batch of vectors."""
    off = np.concatenate([[0], np.cumsum(np.diff(batch.column("terms").offsets.to_numpy()))])
    begin = 0
    while begin < batch.num_rows:
        end = min(begin + SHARD_DOCS, max(begin + 1, int(np.searchsorted(off, off[begin] + SHARD_PAIRS, "right")) - 1))
        yield batch.slice(begin, end - begin)
        begin = end


def _search(block, top):
    def run(batches):
        own = block.value
        search = Search(own, top)
        for batch in batches:
            for part in _shards(batch):
                terms = part.column("terms")
                size = np.diff(terms.offsets.to_numpy())
                of = np.repeat(np.arange(part.num_rows), size)
                term, tf = terms.flatten().to_numpy(), part.column("tf").flatten().to_numpy().astype(np.int64)
                value = own.coordinates(part.column("n").to_numpy()[of], term, tf)
                search.add(Documents(part.column("_id").to_numpy(), of, term, value))
        for item, (ids, score) in enumerate(search.best):
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), item, np.int32)), pa.array([own.ids[item]] * len(ids), pa.string()), pa.array(ids), pa.array(score)],
                    names=["item", "item_id", "_id", "score"])
    return run


def _ranked(found: DataFrame, top: int) -> DataFrame:
    for by in (["item", F.pmod(F.xxhash64("_id"), F.lit(PARTS))], ["item"]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "_id"))
        found = found.withColumn("rank", place).filter(F.col("rank") <= top)
    return found


def _of_block(rows: DataFrame, block: Block, seeds: int, top: int) -> DataFrame:
    spark = rows.sparkSession
    terms = spark.sparkContext.broadcast(block)
    part = (F.pmod(F.xxhash64("_id"), F.lit(seeds)) == 0).alias("seed")
    vectors = cut_lineage(rows.mapInArrow(_vectors(terms), VECTORS).select("*", part), "vectors", partition_by="seed")
    terms.unpersist()
    size = vectors.filter("n > 0").agg(F.count("*"), F.sum("n")).first()
    block.documents, block.words = size[0], size[1] or 0
    # as many rows as the block has terms
    df = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    term, count = df.column("term").to_numpy(), df.column("count").to_numpy()
    block.weight[term] = [math.floor(1000 * math.log((2 * block.documents + 2) / (2 * c + 1))) for c in count.tolist()]

    def search(some: DataFrame) -> DataFrame:
        return _ranked(some.drop("seed").mapInArrow(_search(spark.sparkContext.broadcast(block), top), FOUND), top)

    for r in search(vectors.filter("seed")).filter(F.col("rank") == top).select("item", "score").collect():  # a row an item at most
        block.floor[r.item] = r.score
    done = cut_lineage(search(vectors).select("item_id", "rank", F.when(F.col("_id") != NULL_ID, F.col("_id")).alias("doc_id"), "score"), "ranked")
    drop_cut(vectors)
    return done


def search(docs: DataFrame, benchmark: DataFrame, top: int = TOP, block_words: int = BLOCK_WORDS, seed_docs: int = SEED_DOCS) -> DataFrame:
    """One row per item and rank: item_id (of the benchmark's type), rank, doc_id, score."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("_id"), "text")
    seeds = max(1, math.ceil(rows.count() / seed_docs))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").filter("text is not null")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / 2 / block_words))  # a word takes two characters at least, its separator included
    parts = []
    for b in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        parts.append(_of_block(rows, Block([r.item_id for r in own], [r.text for r in own]), seeds, top))
    out = parts[0]
    for more in parts[1:]:
        out = out.union(more)
    return out.withColumn("item_id", F.col("item_id").cast(benchmark.schema["item_id"].dataType))
