"""The whole licence scan against brute force: every unit's cosine, files, directories."""

import math
import random
import re

from llm_fixtures import prose, same

from ordermart.llm import licences as X
from pyspark.sql import functions as F

MARK = re.compile(X.MARK)


def unit_terms(text):
    return set(X.plain_terms(text))


def brute_blocks(text):
    """Successive lines, all of a comment or none, up to an empty line."""
    out, now, kind = [], [], None
    for line in text.split("\n"):
        mark = bool(MARK.match(line))
        empty = not re.sub(r"[ \t\r]", "", line)
        if empty or now and mark != kind:
            out.append(now)
            now = []
        if not empty:
            now.append(line)
            kind = mark
    out.append(now)
    return [b for b in out if len(b) > 1 and len(b) < len(text.split("\n"))]


def brute(files):
    vocabulary = {w for _, t in X.TEMPLATES for w in unit_terms(t)}
    total = len(files)
    idf = {w: math.log(1 + (total + 1) / (sum(w in unit_terms(t or "") for _, _, t in files) + 1)) for w in vocabulary}
    other = math.log(1 + (total + 1) / 2)
    vectors = [(name, unit_terms(t)) for name, t in X.TEMPLATES]

    def licence(text):
        own = unit_terms(text)
        length = math.sqrt(sum(idf.get(w, other) ** 2 for w in own))
        best = (0, 1)
        for i, (name, t) in enumerate(vectors):
            cosine = round(sum(idf[w] ** 2 for w in own & t) / (length * math.sqrt(sum(idf[w] ** 2 for w in t))), 10) if own else 0
            best = max(best, (cosine, -i))
        return (vectors[-best[1]][0], best[0]) if best[0] >= X.LEAST else None

    judged, licensed = [], {}
    for i, path, text in files:
        text = text or ""
        whole = licence(text)
        found = None
        for units in ([text], ["\n".join(b) for b in brute_blocks(text)], text.split("\n")):
            hits = [x for x in map(licence, units) if x]
            if hits:
                found = min(hits, key=lambda x: (-x[1], x[0]))
                break
        judged.append((i, path, found))
        if whole and path is not None:
            licensed.setdefault(path.rpartition("/")[0], []).append((path, whole[0]))
    out = []
    for i, path, found in judged:
        if found:
            out.append((i, path, found[0], round(found[1], 9), "own", path))
            continue
        near = None
        if path is not None:
            parts = path.split("/")[:-1]
            for k in range(len(parts), -1, -1):
                if "/".join(parts[:k]) in licensed:
                    near = min(licensed["/".join(parts[:k])])
                    break
        out.append((i, path, near[1] if near else None, None, "inherited" if near else None, near[0] if near else None))
    return out


def test_scan_equals_brute_force(spark):
    rng = random.Random(5)
    texts = dict(X.TEMPLATES)
    names = [n for n, _ in X.TEMPLATES]
    files = []
    for i in range(150):
        path = None if i % 29 == 0 else "/".join([*(rng.choice("abc") for _ in range(rng.randrange(0, 4))), f"f{i}"])
        body = [prose(rng, rng.randrange(0, 12)) for _ in range(rng.randrange(0, 6))]
        kind = rng.randrange(7)
        statement = rng.choice([t for _, t in X.TEMPLATES if len(t) < 200])
        header = rng.choice(X.HEADERS)
        if kind == 0:
            body = [rng.choice([texts[rng.choice(names)], statement])]
        elif kind == 1:
            body.insert(rng.randrange(len(body) + 1), rng.choice(["", "# ", "// ", " * "]) + statement)
        elif kind == 2:
            words = " ".join(header[1:]).split()
            wrapped = ["# " + " ".join(words[k: k + 11]) for k in range(0, len(words), 11)]
            body = wrapped + ["import x"] + body
        elif kind == 3:
            body += [statement] * 2 + ["almost licensed", "SPDX-License-Identifier: MIT"][: rng.randrange(3)]
        files.append((i, path, None if i % 31 == 0 else "\n".join(body)))
    files += files[:3]
    df = spark.createDataFrame(files, "id long, path string, text string")
    got = [(r.id, r.path, r.licence, None if r.cosine is None else round(r.cosine, 9), r.origin, r.licence_path) for r in X.scan(df, "id", F.col("path")).collect()]
    expected = brute(files)
    assert {x[4] for x in expected} == {"own", "inherited", None}
    same(got, expected)
