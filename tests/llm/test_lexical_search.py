"""Ranked lexical search against brute force, and its trees' bounds."""

import math
import random
import re
from collections import Counter

import numpy as np
from llm_fixtures import frame, prose, same

from ordermart.llm import lexical_search as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, items, top=10):
    docs = [(i, Counter(terms(t)), len(terms(t))) for i, t in rows]
    docs = [d for d in docs if d[2]]
    n_docs, n_words = len(docs), sum(d[2] for d in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in docs:
            m = 25 + 75 * n * n_docs // n_words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if score > 0:
                scored.append((-score, -(2**63) if i is None else i, i))
        scored.sort(key=lambda x: x[:2])
        out += [(item, k, i, -s) for k, (s, _, i) in enumerate(scored[:top], 1)]
    return out


def items_of(corpus):
    rng = random.Random(12)
    some = [t for _, t in corpus if t and len(t) > 100]
    cut = [(100 + k, " ".join(rng.choice(some).split()[5 * k: 5 * k + 12])) for k in range(30)]
    return cut + [(1, None), (2, ""), (3, " .,-"), (4, "a a a A b"), (5, "nothing-of-this occurs"), (None, "short text"), (7, "Short, text! SHORT"),
                  (8, "数据处理" * 200), (8, "ünïcode été été"), (9, "a b c d e"), (9, "a b c d e")]


def bench(spark, items, kind="long"):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in items], f"item_id {kind}, text string, score string, rank int")


def result(df):
    return [tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()]


def test_lexical_search(spark, docs, corpus):
    items = items_of(corpus)
    found = L.search(docs, bench(spark, items))
    assert dict(found.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    same(result(found), brute(corpus, items))
    # several blocks of items, floors of few documents, other tops
    same(result(L.search(docs, bench(spark, items), block_words=300, seed_docs=5)), brute(corpus, items))
    same(result(L.search(docs, bench(spark, items), top=1, seed_docs=3)), brute(corpus, items, 1))


def test_many_documents_ties_and_copies(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(vocab[min(int(rng.expovariate(0.02)), 299)] for _ in range(n))
    copy = text(30)
    rows = [(i, text(rng.randrange(1, 60))) for i in range(1500)] + [(5000 - i, copy) for i in range(600)]
    items = [(k, text(10)) for k in range(70)] + [(70, copy), (71, vocab[299])]
    same(result(L.search(frame(spark, rows).repartition(6), bench(spark, items), seed_docs=300)), brute(rows, items))
    text_ids = [(f"i{k}", t) for k, t in items[:5]]
    same(result(L.search(frame(spark, rows), bench(spark, text_ids, "string"))), brute(rows, text_ids))


def test_empty_tables(spark, docs, nothing):
    assert result(L.search(nothing, bench(spark, [(1, "a b")]))) == []
    assert result(L.search(docs, bench(spark, []))) == []
    assert result(L.search(frame(spark, [(1, None), (2, " . ")]), bench(spark, [(1, "a b")]))) == []


def sparse(rng, rows, terms, values):
    of = np.repeat(np.arange(rows), rng.integers(0, 12, rows))
    key = np.unique(of * terms + rng.zipf(1.4, len(of)) % terms)
    return key // terms, key % terms, rng.integers(1, values, len(key))


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    block = L.Block([str(i) for i in range(90)], [prose(random.Random(i), 8, 60) for i in range(90)])
    of, term, value = sparse(rng, 4000, len(block.names), 10**9)
    ids = rng.permutation(4000)
    tree = L.Documents(ids, of, term, value)
    dense = np.zeros((4000, len(block.names)), np.int64)
    dense[of, term] = value
    place = {int(i): k for k, i in enumerate(ids)}
    rows = dense[[place[int(i)] for i in tree.ids]]
    first, own_term, count = block.levels[0]
    exact = np.stack([rows[:, own_term[a:b]] @ count[a:b] for a, b in zip(first[:-1], first[1:], strict=True)])
    for height, (first, own_term, count) in enumerate(block.levels):
        for node in range(len(first) - 1):
            own = slice(first[node], first[node + 1])
            for level, (size, _, _) in enumerate(tree.levels):
                for nodes in (np.arange(size), np.arange(size)[:: 37]):
                    bound = tree.bounds(level, nodes, own_term[own], count[own])
                    for x, most in zip(nodes.tolist(), bound.tolist(), strict=True):
                        below = exact[node * 8**height: (node + 1) * 8**height, x * 8**level: (x + 1) * 8**level]
                        assert below.max() <= most and (height or level or below.max() == most)
    full = L.Search(block, 10)
    full.add(tree)
    block.floor = np.array([score[-1] for _, score in full.best])
    again = L.Search(block, 10)
    again.add(tree)
    assert again.compared < full.compared / 2  # floors prune
    for item, ((a, s), (b, t)) in enumerate(zip(full.best, again.best, strict=True)):
        order = np.lexsort((tree.ids, -exact[item]))[:10]
        assert np.array_equal(a, b) and np.array_equal(s, t) and np.array_equal(a, tree.ids[order]) and np.array_equal(s, exact[item][order])
