"""Fill-in-middle against brute force, and its rank index alone."""

import hashlib
import random

import numpy as np
import pytest
from llm_fixtures import frame, same

from ordermart.llm import fill_middle


def brute(rows, plain=10, spm=20):
    out = []
    for i, t in rows:
        t = t or ""
        digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(digest[k: k + 8], 16) for k in (0, 8, 16, 24))
        a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
        if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100 - plain:
            out.append((i, len(t), "plain", None, None, t))
        elif h4 % 100 < spm:
            out.append((i, len(t), "spm", a, b - a, f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"))
        else:
            out.append((i, len(t), "psm", a, b - a, f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}"))
    return out


def sentinel_like():
    rng = random.Random(11)
    parts = ["<", ">", "P", "S", "M", "<P", "S>", "<<", "é", "🎉", "\n", " "]
    return [(1000 + i, "".join(rng.choice(parts) for _ in range(rng.randrange(0, 30)))) for i in range(400)]


def test_fill_in_middle(spark, corpus):
    rows = corpus + sentinel_like() + [(i, "aé数🎉"[: i % 5] * (i % 40)) for i in range(2000, 2300)] + [(3000, "é🎉a" * 400_000)]
    done = fill_middle.fill_in_middle(frame(spark, rows).repartition(3))
    same(map(tuple, done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()), brute(rows))
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    got = fill_middle.report(done).select("doc_id", "output_sha256", "restored_sha256").collect()
    same(map(tuple, got), [(i, digest(o[-1]), digest(t)) for (i, t), o in zip(rows, brute(rows), strict=True)])
    assert {o[2] for o in brute(rows)} == {"psm", "spm", "plain"}


def test_shares_are_parameters(spark):
    rows = [(i, f"text of document {i}") for i in range(50)]
    for plain, spm in ((100, 0), (0, 100), (0, 0)):
        done = fill_middle.fill_in_middle(frame(spark, rows), plain=plain, spm=spm)
        same(map(tuple, done.collect()), brute(rows, plain, spm))


def test_no_documents(nothing):
    assert fill_middle.report(fill_middle.fill_in_middle(nothing)).count() == 0


@pytest.mark.parametrize("block", [64, 1000, 1 << 20])
@pytest.mark.parametrize("error", [1, 8, 100])
def test_rank_index(error, block):
    rng = random.Random(5)
    texts = ["", "a", "plain ascii " * 50, "🎉" * 300, "".join(rng.choice("aé数🎉") for _ in range(2_000)), "a" * 500 + "🎉" * 500 + "a" * 500, "x" * 64, "é" * 32]
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        index = fill_middle.RankIndex(data, error, block)
        truth = np.cumsum([0] + [len(c.encode()) for c in text])
        assert np.array_equal(index(np.arange(len(text) + 1)), truth)
        assert np.abs(index.residual.astype(int)).max() <= error and len(index.residual) == len(text) + 1
    uniform = fill_middle.RankIndex(np.frombuffer(b"a" * 100_000, np.uint8), error)
    assert len(uniform.rank) == 1
