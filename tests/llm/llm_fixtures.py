"""Documents for the operators' tests: nulls, empty and long texts, copies, repeated rows, clashing columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, _th string, row string, n int, key string, spans string"


def prose(rng, n, words=400):
    vocab = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(1, 9))) for _ in range(words)]
    return " ".join(rng.choice(vocab) for _ in range(n))


def texts():
    rng = random.Random(3)
    base, other, passage = prose(rng, 300), prose(rng, 900), prose(rng, 60)
    edited = base.split()
    edited[100] = "changed"
    half = base.split()[:150] + prose(rng, 150).split()
    long = prose(rng, 30_000, 5_000)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "Short text."), (5, long), (6, long), (7, long[:90_000]),
        (8, base), (9, " ".join(edited)), (10, " ".join(half)), (11, base.replace(" ", "\n", 7)), (12, other + " " + passage),
        (13, passage + " " + prose(rng, 200)), (14, "a " * 4_000), (15, "x" * 5_000), (16, "ab" * 3_000), (17, "数据处理" * 200),
        (18, "Ünïcode ÉTÉ – naïve’s café 🎉 ŒUVRE " * 30), (19, other), (19, other), (20, "<|endoftext|> 'S don't <|ENDOFTEXT|>"),
        (None, prose(rng, 80)), (None, None), (21, prose(rng, 4)), (22, "a b c d e"), (23, "A B C d e"), (24, "line one here\n" * 12 + "# | $ last"),
    ]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "x", "y", "z", 1, "k", "q") for i, t in rows], SCHEMA)


def same(rows, expected):
    """Rows as a multiset, whatever their order."""
    text = lambda x: sorted(map(repr, x))
    assert text(tuple(r) for r in rows) == text(expected)
