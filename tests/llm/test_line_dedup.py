"""Line dedup against brute force."""

import hashlib
import random

from llm_fixtures import frame, prose, same

from ordermart.llm import line_dedup

SPACES = " \t\n\x0b\x0c\r"
LOWER = str.maketrans(line_dedup.UPPER, line_dedup.UPPER.lower())


def brute(rows, min_chars=20, min_docs=3):
    least = -(2**63)
    key = lambda line: line.strip(SPACES).translate(LOWER)
    held = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            held.setdefault(key(line), set()).add(least if i is None else i)
    keeper = {k: max(v) for k, v in held.items() if len(k) >= min_chars and len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if keeper.get(key(x)) in (None, least if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def lines_corpus():
    rng = random.Random(13)
    common = [prose(rng, 6) for _ in range(12)] + ["ÉTÉ à la plage, naïve et TRÈS long", "x" * 19, "y" * 20, "数据处理" * 5, "Z" * 20 + "É"]
    dress = [lambda x: x, str.upper, lambda x: f"  {x}\t", lambda x: x + "\r", lambda x: "\x0b" + x.title(), lambda x: " " + x]
    rows = []
    for i in range(60):
        parts = [rng.choice(dress)(rng.choice(common)) if rng.random() < 0.4 else prose(rng, rng.randrange(0, 9)) for _ in range(rng.randrange(1, 9))]
        rows.append((i, "\n".join(parts)))
    return rows


def test_line_dedup(spark, corpus, docs):
    same(map(tuple, line_dedup.report(line_dedup.drop_common_lines(docs)).collect()), brute(corpus))


def test_dressed_lines_nulls_ties_and_repeated_rows(spark):
    hot = "A line that is in every document."
    rows = lines_corpus() + [
        (100, None), (101, ""), (102, "\n\n"), (103, hot), (104, hot.lower() + "\n" + hot), (105, hot + "\n\n" + hot.upper() + " \r\nlast"),
        (105, hot + "\n\n" + hot.upper() + " \r\nlast"), (106, "two rows of one id share this line"), (106, "two rows of one id share this line\nmore"),
        (107, "two rows of one id share this line"), (None, hot), (None, hot + "\nnull id"), (None, None), (108, "a\n" * 3_000 + hot), (109, "x " * 30_000)]
    same(map(tuple, line_dedup.report(line_dedup.drop_common_lines(frame(spark, rows).repartition(4))).collect()), brute(rows))
    done = {r.doc_id: r for r in line_dedup.drop_common_lines(frame(spark, rows), min_chars=1, min_docs=2).collect() if r.doc_id is not None and r.doc_id != 106}
    assert done[104].dropped == [0, 1] and done[104].kept == ""
    same([(i, r.n_lines, len(r.dropped), hashlib.sha256(r.kept.encode()).hexdigest()) for i, r in done.items()],
         {x for x in brute(rows, 1, 2) if x[0] is not None and x[0] != 106})


def test_one_line_in_every_document(spark):
    rows = [(i, f"own line {i} of this document\nthe very common line of all\nend {i % 7}") for i in range(3_000)]
    same(map(tuple, line_dedup.report(line_dedup.drop_common_lines(frame(spark, rows))).collect()), brute(rows))


def test_no_documents(nothing):
    done = line_dedup.report(line_dedup.drop_common_lines(nothing))
    assert done.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"] and done.count() == 0


def test_main_path_is_native(docs):
    plan = line_dedup.report(line_dedup.drop_common_lines(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
