"""Operators 2, 7 and 8 against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import same

from ordermart.llm import components, induced_sort, ngram_join, substring_dedup, suffix_dedup
from ordermart.session import cut_lineage

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def covered(sequences, window):
    seen = Counter(tuple(s[i: i + window]) for s in sequences for i in range(len(s) - window + 1))
    out = []
    for s in sequences:
        hit = [False] * len(s)
        end = 0
        for i in range(len(s) - window + 1):
            if seen[tuple(s[i: i + window])] > 1:
                hit[max(i, end): i + window] = [True] * (i + window - max(i, end))
                end = i + window
        out.append(hit)
    return out


def test_substring_dedup(docs, corpus):
    words = [WORD.findall(t or "") for _, t in corpus]
    expected = []
    for (i, _), w, hit in zip(corpus, words, covered(words, 35), strict=True):
        kept = " ".join(x for x, h in zip(w, hit, strict=True) if not h)
        expected.append((i, len(w), sum(hit), hashlib.sha256(kept.encode()).hexdigest()))
    same(substring_dedup.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect(), expected)


@pytest.mark.parametrize("rounds", [0, 1, 2, 3])
def test_equal_windows_pick_equal_keys(rounds):
    rng = np.random.default_rng(rounds)
    for _ in range(60):
        alphabet = int(rng.choice([1, 2, 3, 50]))
        words = rng.integers(1, alphabet + 1, 120).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        cuts = np.sort(rng.integers(0, 121, 2))
        first = np.array([0, *cuts, 120])
        at, n, key, _ = substring_dedup.anchors(words, first, 9, rounds)
        of = {int(a) + k: (int(x), k) for a, c, x in zip(at, n, key, strict=True) for k in range(int(c))}
        keys: dict = {}
        for a, b in zip(first[:-1], first[1:], strict=True):
            for s in range(a, b - 8):
                keys.setdefault(tuple(words[s: s + 9]), set()).add(of[s][0])
        assert all(len(k) == 1 for k in keys.values())


def test_without_repeats_keeps_rows_and_columns(docs):
    out = substring_dedup.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()


def test_suffix_dedup(docs, corpus):
    data = [(t or "").encode() for _, t in corpus]
    expected = []
    for (i, _), b, hit in zip(corpus, data, covered(data, 200), strict=True):
        spans = sum(h and (k == 0 or not hit[k - 1]) for k, h in enumerate(hit))
        kept = bytes(x for x, h in zip(b, hit, strict=True) if not h)
        expected.append((i, len(b), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    rows = suffix_dedup.remove_repeats(docs).collect()
    same([(r.doc_id, r.n_bytes, r.n_removed, len(r.spans or []), r.kept_sha256) for r in rows], expected)


def test_suffix_dedup_of_copies_before_empty_texts(spark):
    """An empty text after a copy doesn't change whether the copy's end is a token's end."""
    for text in (b"word.\n", b"some words "):
        data = np.frombuffer(text + b"other text", np.uint8)
        off = np.array([0, len(text), len(text), len(text), len(data)])
        assert suffix_dedup.tokens(data, off)[3].tolist()[:3] == [True, False, False]
    rng = random.Random(11)
    rows = []
    for i in range(0, 240, 6):
        tail = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(60))[:rng.randrange(194, 230)] + rng.choice(["ab.\n", "ab ", "ab.\n\n"])
        rows += [(i, f"{i} " + tail), (i + 1, ""), (i + 2, None), (i + 3, f"{i * 7} and " + tail), (i + 4, "other"), (i + 5, tail)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    data = [(t or "").encode() for _, t in rows]
    expected = [(i, sum(hit)) for (i, _), hit in zip(rows, covered(data, 200), strict=True)]
    same([(r.doc_id, r.n_removed) for r in suffix_dedup.remove_repeats(docs).collect()], expected)


@pytest.mark.parametrize("alone", [True, False])
def test_suffix_dedup_of_long_runs(spark, alone):
    """Texts without a symbol of some level: runs of a character or of spaces, short periods, unspaced CJK."""
    rng = random.Random(6)
    odd = ["0" * 1_000, " " * 2_000, "x" * 5_000, "数据处理" * 120, "数" * 300, "abc " * 63, "ab" * 130, "\n" * 250, "é" * 200]
    company = [] if alone else [" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(200)) for _ in range(5)]
    for rows in [[(1, t)] for t in odd[:4]] if alone else [[*enumerate([*company, *odd])], [*enumerate([*company, odd[0]])]]:
        data = [t.encode() for _, t in rows]
        expected = [(i, sum(hit)) for (i, _), hit in zip(rows, covered(data, 200), strict=True)]
        got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
        same([(r.doc_id, r.n_removed) for r in got.collect()], expected)


def plain_order(text, cap):
    ends = [i for i, x in enumerate(text) if x == 0]
    end = lambda i: next(e for e in ends if e >= i)
    order = sorted((i for i in range(len(text)) if text[i]), key=lambda i: (*[(int(x), 0) for x in text[i: end(i)]], (0, end(i))), reverse=True)

    def common(i, j):
        k = 0
        while text[i + k] and text[i + k] == text[j + k] and k < cap:
            k += 1
        return k
    return order, [0] + [common(a, b) for a, b in zip(order, order[1:], strict=False)]


@pytest.mark.parametrize("chunk,tail,memory", [(3, 1, 2), (7, 5, 5), (1 << 20, 1 << 16, 1 << 20)])
def test_induced_sort(monkeypatch, chunk, tail, memory):
    monkeypatch.setattr(induced_sort, "CHUNK", chunk)
    monkeypatch.setattr(induced_sort, "TAIL", tail)
    rng = random.Random(chunk)
    for _ in range(40):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            a = rng.choice([1, 2, 3, 20])
            parts += [rng.randrange(1, a + 1) for _ in range(rng.randrange(1, 40))] + [0]
        parts *= rng.choice([1, 2])
        with induced_sort.Folder() as folder:
            text = folder.array(np.uint16, len(parts))
            text[:] = parts
            got = list(induced_sort.sorted_suffixes(text, 10, folder, memory))
        at, lcp = (np.concatenate(x).tolist() for x in zip(*got, strict=True))
        assert (at, lcp) == plain_order(parts, 10)


class Counted(np.ndarray):
    """An array that counts the places it is read at by arrays of places."""

    def __array_finalize__(self, other):
        self.read = getattr(other, "read", None)

    def __getitem__(self, i):
        if isinstance(i, np.ndarray):
            self.read[0] += i.size
        return super().__getitem__(i)


def test_induced_sort_compares_several_symbols_at_a_time():
    """Places of the text read one by one, for suffixes that share up to 200 symbols with their neighbours."""
    rng = random.Random(4)
    passage = [rng.randrange(1, 257) for _ in range(400)]
    parts = [x for _ in range(40) for x in [*passage, rng.randrange(1, 257), 0]]
    with induced_sort.Folder() as folder:
        text = np.array(parts, np.uint16).view(Counted)
        text.read = [0]
        got = list(induced_sort.sorted_suffixes(text, 200, folder))
    at, lcp = (np.concatenate(x).tolist() for x in zip(*got, strict=True))
    assert sum(lcp) > 100 * len(parts)
    assert text.read[0] < 20 * len(parts)
    assert (at, lcp) == plain_order(parts, 200)


@pytest.mark.parametrize("memory", [1 << 20, 300])
def test_induced_sort_of_names_reads_each_place_a_few_times(memory):
    """A sequence of names too long for memory has almost as many symbols as places: no symbol may look at all that are left."""
    names = random.Random(5).sample(range(1, 8001), 8000)
    with induced_sort.Folder() as folder:
        text = np.array([*names, 0], np.int32).view(Counted)
        text.read = [0]
        order = induced_sort.sort_suffixes(text, 8000, memory, folder).tolist()
    assert order == sorted(range(len(names)), key=names.__getitem__)
    assert text.read[0] < 30 * len(names)


def test_suffix_dedup_counts_equal_strings_without_a_sort(spark, monkeypatch):
    plans = {}

    def cut(df, name, **options):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return cut_lineage(df, name, **options)
    monkeypatch.setattr(suffix_dedup, "cut_lineage", cut)
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(120))
    docs = spark.createDataFrame([(0, text), (1, text + " more"), (1, text), (None, text[50:]), (3, "other")], "doc_id long, text string")
    data = [r.text.encode() for r in docs.collect()]
    got = suffix_dedup.remove_repeats(docs).collect()
    same([(r.doc_id, r.n_removed) for r in got], [(i, sum(hit)) for i, hit in zip([0, 1, 1, None, 3], covered(data, 200), strict=True)])
    assert "SortAggregate" not in plans["suffix-bodies"]


@pytest.mark.parametrize("chunk", [3, 64, 1 << 20])
def test_sort_suffixes_in_slots(monkeypatch, chunk):
    monkeypatch.setattr(induced_sort, "CHUNK", chunk)
    rng = random.Random(chunk)
    for _ in range(40):
        a = rng.choice([1, 2, 3, 200])
        names = [rng.randrange(1, a + 1) for _ in range(rng.randrange(1, 200))] * rng.choice([1, 1, 3])
        with induced_sort.Folder() as folder:
            got = induced_sort.sort_suffixes(np.array([*names, 0], np.int32), max(names), rng.choice([2, 20, 1000]), folder).tolist()
        assert got == sorted(range(len(names)), key=lambda i: [*names[i:], 0])


def linked_components(corpus):
    sets = []
    for _, t in corpus:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i: i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(sets)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(corpus):
        r = find(k)
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    return [(i, len(s), least[find(k)]) for k, ((i, _), s) in enumerate(zip(corpus, sets, strict=True))]


def test_ngram_join(docs, corpus):
    same(ngram_join.near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect(), linked_components(corpus))


def test_ngram_join_of_edited_copies(spark):
    from llm_fixtures import frame, prose

    rng = random.Random(8)
    rows = []
    for group in range(5):
        base = prose(rng, rng.randrange(6, 260)).split()
        for _ in range(40):
            copy = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 20)):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(50)}"
            rows.append((len(rows), " ".join(copy)))
    same(ngram_join.near_duplicates(frame(spark, rows)).select("doc_id", "n_shingles", "component_id").collect(), linked_components(rows))


def test_representatives(docs):
    kept = ngram_join.representatives(docs)
    assert kept.columns == docs.columns
    again = ngram_join.near_duplicates(cut_lineage(kept, "kept"))
    assert again.filter("n_shingles > 0").groupBy("component").count().filter("count > 1").count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7), (200, 201), (201, 200)]
    got = {(r.node, r.component) for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(41)} | {(90, 90), (95, 90), (100, 90), (200, 200), (201, 200)}


def test_empty_tables(nothing):
    assert substring_dedup.remove_repeats(nothing).count() == 0
    assert suffix_dedup.remove_repeats(nothing).count() == 0
    assert ngram_join.near_duplicates(nothing).count() == 0
