"""Operators 1, 3, 4, 5, 6, 9, 10 and the pipeline: brute force, round trips and held-out accuracy."""

import base64
import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
from llm_fixtures import frame, prose, same

from ordermart.llm import bpe, decontaminate, language, licences, quality, queries, token_files, warc
from ordermart.session import scratch_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def tiktoken_counts(texts):
    import tiktoken

    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    coder = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return [len(coder.encode_ordinary(t or "")) for t in texts]


def test_token_counts(docs, corpus, nothing):
    got = token_files.document_counts(docs, RANKS, public_tokenizers.PATTERN, 50256).collect()
    same(got, [(i, n) for (i, _), n in zip(corpus, tiktoken_counts([t for _, t in corpus]), strict=True)])
    assert token_files.document_counts(nothing, RANKS, public_tokenizers.PATTERN, 50256).count() == 0


def test_documents_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 16)
    rng = random.Random(2)
    rows = [(i * 10**15, prose(rng, rng.choice([0, 1, 3, 40, 300]))) for i in range(60)]
    df = frame(spark, rows).repartition(4)
    path = scratch_path(spark, "blocks")
    token_files.write_flat(df, path, RANKS, public_tokenizers.PATTERN, 50256)
    got = token_files.count_tokens(spark, path, 50256)
    assert got.count() == 60
    counted = token_files.document_counts(df, RANKS, public_tokenizers.PATTERN, 50256).collect()
    same(counted, [(i, n) for (i, _), n in zip(rows, tiktoken_counts([t for _, t in rows]), strict=True)])


def test_bpe_equals_the_library(docs, corpus, nothing):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD_BPE)
    expected = []
    for i, t in corpus:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((i, struct.pack(f"<{len(ids)}I", *ids), library.decode(ids, skip_special_tokens=False)))
    same([(r.doc_id, bytes(r.ids), r.decoded) for r in bpe.round_trip(docs, WORD_BPE).collect()], expected)
    assert bpe.round_trip(nothing, WORD_BPE).count() == 0


def test_bpe_of_odd_words():
    from tokenizers import Tokenizer

    library, coder, rng = Tokenizer.from_file(WORD_BPE), bpe.Coder(WORD_BPE), random.Random(1)
    texts = ["İstanbul ΑΣ ΣΣ", "a" * 999, "ab" * 300, "x\x1cy\x85z\xa0", "<|startoftext|><|endoftext|>a", "é́ ẞ ﬀ ½²٣"]
    texts += ["".join(rng.choice("abct '’.,é\n") for _ in range(200)) for _ in range(200)]
    ids, decoded = coder.code(texts)
    for t, i, d in zip(texts, ids, decoded, strict=True):
        own = library.encode(t, add_special_tokens=False).ids
        assert (struct.pack(f"<{len(own)}I", *own), library.decode(own, skip_special_tokens=False)) == (i, d.decode())


def test_warc(spark):
    rows = [(5, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (9, None, None), (7, "u", ""), (2, "http://a/2", "<p>one</p>"),
            (None, "n", "<p>one</p>"), (11, "has space\r\nand break", "WARC/1.1\r\n\r\n\r\nContent-Length: 3\r\n\r\n é🎉"), (12, "l", "x" * 300_000)]
    pages = spark.createDataFrame([(*r, "e") for r in rows], "page_id long, url string, html string, place string").repartition(3)
    got = warc.archive(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    digest = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    least, expected = {"<p>one</p>": 2, "": 7}, []
    seen = Counter()
    for page, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        t = html or ""
        first = page == least.get(t, page) and not seen[t]
        seen[t] += 1
        expected.append((page, len(t.encode()), digest(t), "response" if first else "revisit", None if first else least[t]))
    same(got, expected)
    kept = warc.archive(pages, least_bytes=1).filter("payload_bytes = 0").collect()
    assert [r.record_type for r in kept] == ["response", "response"]
    assert warc.archive(pages.limit(0)).count() == 0


def test_warc_archives_are_read_in_splits(spark, tmp_path):
    """An archive much longer than a split, records that cross splits, and payloads that don't compress."""
    rnd = random.Random(9)
    rows = [(i, f"u{i}", "".join(chr(rnd.randrange(33, 0x2000)) for _ in range(rnd.choice([0, 5, 300, 3000])))) for i in range(400)]
    rows += [(i + 1000, "again", html) for i, _, html in rows[::3]]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    raw, done = str(tmp_path / "raw"), str(tmp_path / "done")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        warc.write_pages(pages, raw)
        assert warc.read(spark, raw).rdd.getNumPartitions() > 20
        warc.resolve(spark, raw, done)
        got = warc.read(spark, done, with_payload=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    least = {}
    for page, _, html in rows:
        least[html] = min(page, least.get(html, page))
    same([(r.page_id, r.record_type, r.refers_to, zlib.decompress(r.payload).decode()) for r in got],
         [(p, "response" if least[h] == p else "revisit", None if least[h] == p else least[h], h if least[h] == p else "") for p, _, h in rows])
    ids = [r.record_id for r in got]
    assert len(set(ids)) == len(ids)


def test_warc_members_are_gzip(spark):
    import gzip

    one = warc.record("response", 1, "http://a", warc.digest_of(b"hi"), 2, b"hi")
    plain = gzip.decompress(one + warc.EMPTY_MEMBER + one)
    assert plain.count(b"WARC/1.1\r\n") == 2 and plain.endswith(b"hi\r\n\r\n")
    assert [warc.parse(x)[1] for _, x in warc.members(one + warc.EMPTY_MEMBER + one)] == [b"hi", b"hi"]


def test_licences(spark, nothing):
    rows = [(1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/c.txt", "nothing here"), (3, "a/b/d.txt", "text\nLicensed under the Apache License, Version 2.0.\nmore text"),
            (4, "z.txt", None), (5, None, "All rights reserved."), (6, "a/b/LICENSE", "Licensed under CC BY-NC 4.0."), (7, "a/bc/x", ""), (7, "a/bc/x", ""), (8, "q/r", "license")]
    files = spark.createDataFrame([(*r, 0.5) for r in rows], "id long, path string, text string, cosine double")
    from pyspark.sql import functions as F

    got = licences.scan(files, "id", F.col("path")).select("id", "licence", "origin", "licence_path").collect()
    same(got, [(1, "MIT", "own", "a/LICENSE"), (2, "CC-BY-NC-4.0", "inherited", "a/b/LICENSE"), (3, "Apache-2.0", "own", "a/b/d.txt"), (4, None, None, None),
               (5, "All-Rights-Reserved", "own", None), (6, "CC-BY-NC-4.0", "own", "a/b/LICENSE"), (7, "MIT", "inherited", "a/LICENSE"), (7, "MIT", "inherited", "a/LICENSE"),
               (8, None, None, None)])
    assert licences.scan(nothing, "doc_id", F.col("source")).count() == 0


def test_licences_of_equal_lines_and_repeated_rows(spark):
    """A line or a row that occurs k times is judged as one is, and few licence terms, however often, are no licence."""
    mit, few = "Released under the MIT License.", "the mit engineers released many of their very own tools"
    others = [(100 + i, f"o/{i}/x", f"some other words {i}\n{few}") for i in range(20)]
    once = [(1, "a/LICENSE", mit), (2, "b/x", f"text\n{mit}\nmore"), (3, "c/x", few), (4, None, mit), *others]
    rows = [(1, "a/LICENSE", mit)] * 3 + [(2, "b/x", f"text\n{mit}\nmore\n{mit}\n{mit}"), (3, "c/x", "\n".join([few] * 50))] + [(4, None, mit)] * 2 + others * 2
    schema = "id long, path string, text string"
    got, want = ({(r.id, r.licence, r.origin, r.licence_path, None if r.cosine is None else round(r.cosine, 6))
                  for r in licences.scan(spark.createDataFrame(x, schema), "id", licences.F.col("path")).collect()} for x in (rows, once))
    assert got == want and {x[:3] for x in got} >= {(1, "MIT", "own"), (2, "MIT", "own"), (3, None, None), (4, "MIT", "own")}


def test_licence_texts_and_headers(spark):
    """Full texts make licence files; headers count wrapped, in comments and by SPDX tag."""
    rng = random.Random(13)
    texts = dict((name, (licences.resources.files("ordermart.llm") / "licence_texts" / f"{name}.txt").read_text()) for name in licences.TEXTS)
    rows = [(f"{n}/LICENSE", (t.replace("Copyright (c)", "Copyright (c) 2020 Jane Doe") if n in ("MIT", "BSD-2-Clause", "BSD-3-Clause") else t).replace("\n", "\r\n" if n == "MIT" else "\n"), n, "own")
            for n, t in texts.items()]
    rows += [(f"{n}/src/x", prose(rng, 40), n, "inherited") for n in texts]
    for k, (name, *paragraphs) in enumerate(licences.HEADERS):
        words, lines = "\n\n".join(paragraphs).replace("\n\n", " \n ").split(" "), [""]
        for w in words:
            if w == "\n" or len(lines[-1]) > 60:
                lines += ["", ""] if w == "\n" else [""]
            lines[-1] += w.strip("\n") + " "
        for mark in ("", "# ", " * ", "// ", "-- "):
            code = "\n".join(prose(rng, 12) for _ in range(30))
            rows.append((f"h/{k}/{mark.strip().replace('/', 's')}", "\n".join((mark + x).rstrip(" ") for x in ["Copyright 2020 Jane Doe", "", *lines]) + ("\n" if mark else "\n\n") + code, name, "own"))
    code = "\n".join(prose(rng, 12) for _ in range(30))
    rows += [("s/a", "# SPDX-License-Identifier: MIT\n" + code, "MIT", "own"), ("s/b", "/* SPDX-License-Identifier: GPL-2.0-only */\n" + code, "GPL-2.0", "own"),
             ("s/c", "-- SPDX-License-Identifier: Zlib\n" + code, None, None), ("s/d", "Copyright 2020 The Authors. All rights reserved.\n" + code, "All-Rights-Reserved", "own")]
    files = spark.createDataFrame([(i, p, t) for i, (p, t, _, _) in enumerate(rows)], "id long, path string, text string")
    got = licences.scan(files, "id", licences.F.col("path")).select("path", "licence", "origin").collect()
    assert {tuple(r) for r in got} ^ {(p, n, o) for p, _, n, o in rows} == set() and len(got) == len(rows)


def test_licence_cosine_of_all_units(docs, corpus):
    """The filter by heaviest terms loses no unit."""
    texts = [t or "" for _, t in corpus] + [x for _, x in licences.TEMPLATES] + ["this work is licensed under the public license version 3", "rights reserved all all"]
    spark = docs.sparkSession
    units = frame(spark, list(enumerate(texts)))
    rows = units.select("doc_id", licences.terms(licences.F.coalesce("text", licences.F.lit(""))).alias("terms"))
    idf, other = licences.weights(units)
    got = {r.doc_id: (r.licence, round(r.cosine, 6)) for r in licences.matches(rows, idf, other).collect()}
    for i, t in enumerate(texts):
        own = licences.plain_terms(t)
        best = (0.0, "")
        for name, text in licences.TEMPLATES:
            theirs = licences.plain_terms(text)
            dot = sum(idf[w] ** 2 for w in set(own) & set(theirs))
            size = math.sqrt(sum(idf.get(w, other) ** 2 for w in own) * sum(idf[w] ** 2 for w in theirs)) or 1
            best = max(best, (dot / size, name), key=lambda x: (round(x[0], 10), x[1] < best[1]))
        assert (i in got) == (best[0] >= licences.LEAST) and (i not in got or got[i][1] == round(best[0], 6))


def base_counts(text):
    words, seen, dup = re.findall(r"[^\x20\x09-\x0D]+", text), set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i: i + 5]) for i in range(len(words) - 4))
    hit = [False] * len(words)
    for i in range(len(words) - 4):
        if windows[tuple(words[i: i + 5])] > 1:
            hit[i: i + 5] = [True] * 5
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, sum(hit), n < 10 or 100 * sum(hit) > 20 * n


def test_quality(docs, corpus, nothing):
    rows = quality.judge(docs).collect()
    same([tuple(r)[:7] for r in rows], [(i, *base_counts(t or "")) for i, t in corpus])
    assert all(not r.kept for r in rows if r.base_failed)
    verdicts = {tuple(sorted((repr(r.doc_id), r.n_words, r.kept) for r in quality.judge(docs, list(order)).collect()))
                for order in (quality.RULES, reversed(quality.RULES))}
    assert len(verdicts) == 1  # the order doesn't matter
    assert sorted(quality.best_order(docs)) == sorted(quality.RULES) and quality.judge(nothing).count() == 0


def test_decontaminate(spark, docs, corpus, nothing):
    rng = random.Random(4)
    texts = {i: t for i, t in corpus if i}
    items = [(1, " ".join(texts[12].split()[5:30])), (2, "A b C"), (3, None), (4, " ,; "), (10, prose(rng, 30)), (11, " ".join(texts[5].split()[20_000:20_010]).upper()),
             (12, " ".join(texts[12].split()[8:22])), (12, "a b c"), (None, "x")]
    bench = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k: k + 10])].add(i)
    expected = []
    for i, t in corpus:
        w = words(t)
        hit, found = [False] * len(w), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k: k + n])) in windows:
                    hit[k: k + n] = [True] * n
                    found |= windows[x]
        names = sorted(str(x) for x in found if x is not None)
        expected.append((i, len(w), sum(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), sum(hit) > 0))
    named = bench.filter("item_id is not null")
    leaks = decontaminate.find_leaks(docs, named)
    want = [(*e[:2], *e[2:]) for e in expected]
    del windows[("x",)]
    got = decontaminate.report(leaks).collect()
    same(got, want)
    clean = decontaminate.cut(docs, leaks)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert decontaminate.report(decontaminate.find_leaks(clean.filter("doc_id in (5, 12)"), named)).filter("n_hit >= 10").count() == 0
    assert decontaminate.find_leaks(nothing, bench).count() == 0
    assert decontaminate.find_leaks(docs, bench.limit(0)).filter("size(spans) > 0").count() == 0


def test_benchmark_in_blocks(docs, spark, monkeypatch, corpus):
    texts = {i: t for i, t in corpus if i}
    items = [(k, " ".join(texts[i].split()[a: a + 20])) for k, (i, a) in enumerate([(12, 0), (12, 15), (13, 30), (5, 4_000), (8, 100)])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = decontaminate.report(decontaminate.find_leaks(docs, bench)).collect()
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 10)
    same(decontaminate.report(decontaminate.find_leaks(docs, bench)).collect(), [tuple(r) for r in whole])


def test_repeated_benchmark_rows(spark, monkeypatch):
    """An id counts once a document, whether its rows are equal or not and however many blocks hold them."""
    docs = spark.createDataFrame([(1, "alpha beta gamma delta"), (2, "alpha beta"), (3, "epsilon")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "alpha beta"), (7, "alpha beta"), (7, "gamma delta"), (8, "beta gamma"), (None, "epsilon"), (None, "alpha")], "item_id long, text string")
    names = {1: ["7", "8"], 2: ["7"], 3: []}
    expected = [(i, len(x), hashlib.sha256(",".join(x).encode()).hexdigest(), True) for i, x in names.items()]
    for words in (decontaminate.BLOCK_WORDS, 10):
        monkeypatch.setattr(decontaminate, "BLOCK_WORDS", words)
        got = decontaminate.report(decontaminate.find_leaks(docs, bench)).collect()
        same([(r.doc_id, r.n_items, r.items_sha256, r.contaminated) for r in got], expected)


def test_language(spark, docs, nothing):
    rng = random.Random(6)
    parts = {"aa": ["th", "er", "on", "ing", "and"], "bb": ["sch", "ein", "ung", "über", "zz"], "cc": ["ção", "os", "que", "ñ", "el"]}
    rows = []
    for i in range(400):
        lang = rng.choice(list(parts))
        words = ["".join(rng.choice(parts[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(60)]
        rows.append((i, " ".join(words), lang if rng.random() > 0.05 else None, lang))
    rows += [(1000, None, "aa", "aa"), (1001, "123 !!", "aa", "aa"), (None, "schein", None, "bb"), (1002, "", "tiny", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string").repartition(2)
    got = language.identify(df).collect()
    truth = {i: t for i, _, _, t in rows}
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        assert r.lang_pred in {*parts, "und", "tiny"} and (r.lang_pred == "und") == (r.doc_id in (1000, 1001, 1002))
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert language.known(df).columns == df.columns and language.known(df).count() == len(rows) - 3
    assert language.identify(nothing).count() == 0 and language.known(nothing).count() == 0
    unlabelled = docs.withColumn("lang", licences.F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unlabelled).collect()} == {"und"}


def test_training_is_bounded(spark):
    """Long labelled texts give parts, short ones all; the bound holds for the sum."""
    rng = random.Random(12)
    rows = [(4 * i, "".join(rng.choice("abc ") for _ in range(size)), lang)
            for i, (lang, size) in enumerate([("aa", 50_000)] * 8 + [("aa", 30)] * 8 + [("bb", 70_000)] * 3 + [("cc", 100)] * 3)]
    df = spark.createDataFrame([*rows, *rows[:5]], "doc_id long, text string, lang string").filter(~language.held_out())
    own = {lang: {r.text for r in df.filter(licences.F.col("lang") == lang).collect()} for lang in ("aa", "bb", "cc")}
    got = language.training_texts(df, 1000)
    for lang, texts in got.items():
        assert len(texts) == len(own[lang]) and sum(map(len, texts)) <= 1000
        assert all(any(t.startswith(x) for t in own[lang]) for x in texts)
        assert {t for t in own[lang] if len(t) <= 30} <= set(texts)
    assert sum(map(len, got["aa"])) > 980 and max(map(len, got["aa"])) < 300 and set(got["cc"]) == own["cc"]
    assert language.shares([5, 100, 1, 100], 50) == [5, 22, 1, 22] and language.shares([9, 9, 9], 2) == [0, 1, 1]


def test_automaton_of_many_letters():
    letters = [chr(0x4E00 + k) for k in range(20_000)]
    a = language.Automaton("".join(letters))
    assert sum(x.nbytes for x in vars(a).values() if hasattr(x, "nbytes")) < 2_000_000
    assert a.phrases(language.Words(["".join(letters[7:30]), letters[5] + letters[3], "é"])).tolist() == [1, 2, 1]


def test_automaton_phrases():
    rng = random.Random(9)
    for _ in range(50):
        text = "".join(rng.choice("abc") for _ in range(60))
        a = language.Automaton(text)
        words = ["".join(rng.choice("abcd") for _ in range(rng.randrange(30))) for _ in range(20)]
        expected = []
        for word in words:
            n, i = 0, 0
            while i < len(word):
                k = 1
                while i + k < len(word) and word[i: i + k + 1] in text:
                    k += 1
                n, i = n + 1, i + k
            expected.append(n)
        assert a.phrases(language.Words(words)).tolist() == expected
    assert a.phrases(language.Words([])).tolist() == []


def test_held_out_accuracy_on_the_test_data(spark):
    rows = queries.op10_language_id(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
    assert 0 < out.count() <= docs.count() and len(corpus_pipeline.STAGES) == 5


def test_every_stage_keeps_the_columns(spark, docs):
    import corpus_pipeline

    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() > 0
