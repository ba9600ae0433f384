"""Substring dedup by recompression (operator 2).

A window is ``window`` consecutive words of one document.  Every word covered by a window whose word
sequence also starts anywhere else, same document included, is removed; windows are judged on the
input.  Recompression shrinks each word sequence in rounds: a round names maximal runs of one symbol
and then disjoint pairs (left class, right class) by fingerprints of their content, so a name means
the same everywhere and no dictionary is exchanged.  Each symbol carries the exact interval of words
that decided it (its *reach*): equal text over a reach gives the equal symbol at the equal place.

1. Every window picks, among the high-level symbols whose reach lies inside it, the one with the
   least key (name and content of the reach); a window that holds none is its own key.  Equal windows
   pick equal keys at equal offsets, so a window repeats only if its key occurs twice.  Successive
   windows with one choice form an anchor row.
2. Spark counts the keys.  Anchors with a shared key are verified: equal fingerprints of all their
   words settle an anchor's windows at once; under keys whose contents differ, one anchor for each
   content has its windows compared one by one by 128-bit fingerprints.
3. Each document's repeated windows are merged and their words removed.

Null or empty texts have no words; shorter documents have no window and stay whole.  Repeated rows
are documents of their own (their windows repeat each other).  Only doc_id and text are read, so other
columns may have any name.  Empty tables give empty results.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.text import IS_WORD, Ranges, flat, lists, mix, pieces, row_key, spans, word_ids
from ordermart.session import cut_lineage, drop_cut

ROUNDS = 3
_U = np.uint64


def recompress(name, low, high, doc, out_low, out_high, rounds: int = ROUNDS):
    """High-level symbols of many symbol sequences: names and reaches (low, high) of the symbols, both
    ascending, and the sequence of each.

    Returns the new symbols' names and reaches.  A decision that depends on a sequence's end reaches
    past it (``out_low`` and ``out_high`` by sequence), so no window contains it."""
    for r in range(rounds):
        if len(name) < 2:
            break
        salt = _U((2 * r + 1) * 0xA0761D6478BD642F % 2**64)
        # runs of one symbol
        new_doc = np.ones(len(name), bool)
        new_doc[1:] = doc[1:] != doc[:-1]
        start = new_doc.copy()
        start[1:] |= name[1:] != name[:-1]
        begin = np.flatnonzero(start)
        last = np.append(begin[1:], len(name)) - 1
        left_end = new_doc[begin]
        right_end = np.append(new_doc[begin[1:]], True)
        length = (last - begin + 1).astype(np.uint64)
        d = doc[begin]
        low = np.where(left_end, out_low[d], low[begin - 1])
        high = np.where(right_end, out_high[d], high[np.minimum(last + 1, len(high) - 1)])
        name = np.where(length == 1, name[begin], mix(name[begin] + mix(length + salt)))
        doc = d
        # pairs of a left-class and a right-class symbol
        m = len(name)
        left = (mix(name ^ salt) & _U(1)).astype(bool)
        same = np.zeros(m, bool)  # the next symbol is of the same sequence
        same[:-1] = doc[1:] == doc[:-1]
        joins = np.zeros(m, bool)
        joins[:-1] = left[:-1] & ~left[1:] & same[:-1]
        joined = np.zeros(m, bool)
        joined[1:] = joins[:-1]
        after = np.minimum(np.arange(m) + 1, m - 1)
        before = np.maximum(np.arange(m) - 1, 0)
        has_before = np.zeros(m, bool)
        has_before[1:] = same[:-1]
        high2 = np.where(left, np.where(same, high[after], out_high[doc]), high)
        low2 = np.where(left, low, np.where(has_before, low[before], out_low[doc]))
        name2 = np.where(joins, mix(name + mix(name[after] + salt) * _U(3)), name)
        name, low, high, doc = (x[~joined] for x in (name2, low2, high2, doc))
    return name, low, high


def choose(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The index of the least key (leftmost of equals) in each non-empty range [lo, hi]."""
    tables = [np.arange(len(keys))]
    step, widest = 1, int((hi - lo).max()) + 1
    while 2 * step <= widest:
        t = tables[-1]
        other = t[np.minimum(np.arange(len(t)) + step, len(t) - 1)]
        tables.append(np.where(keys[other] < keys[t], other, t))
        step *= 2
    stacked = np.stack(tables)
    level = np.zeros(widest + 1, np.int64)
    for j in range(1, len(tables)):
        level[1 << j:] = j
    k = level[hi - lo + 1]
    a, b = stacked[k, lo], stacked[k, hi - (1 << k) + 1]
    return np.where(keys[b] < keys[a], b, a)


def anchors(words: np.ndarray, first: np.ndarray, window: int, rounds: int = ROUNDS):
    """Anchor rows (first window, number of windows, key, fingerprint of what the windows hold: of all
    their words, or of the one window that windows without a symbol repeat)."""
    sizes = np.diff(first)
    n_windows = np.maximum(sizes - window + 1, 0)
    total = int(n_windows.sum())
    if not total:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64))
    ends = np.cumsum(n_windows)
    s = np.arange(total) + np.repeat(first[:-1] - (ends - n_windows), n_windows)
    content = Ranges(words)
    name, low, high = recompress(words, np.arange(len(words)), np.arange(1, len(words) + 1), np.repeat(np.arange(len(sizes)), sizes),
                                 first[:-1] - 1, first[1:] + 1, rounds)
    inside = (low >= 0) & (high <= len(words))
    a, b = np.where(inside, low, 0), np.where(inside, high, 0)
    keys = mix(name + content(a, b))
    lo = np.searchsorted(low, s, "left")
    hi = np.searchsorted(high, s + window, "right") - 1
    some = hi >= lo
    pick = -1 - s  # a window without a symbol stands alone
    if some.any():
        pick[some] = choose(keys, lo[some], hi[some])
    start = np.ones(total, bool)
    start[1:] = (pick[1:] != pick[:-1]) | (s[1:] != s[:-1] + 1)
    begin = np.flatnonzero(start)
    count = np.diff(np.append(begin, total))
    first_window, chosen = s[begin], pick[begin]
    alone = mix(content(first_window, first_window + window) ^ _U(0x8EBC6AF09C88C6E3))
    key = np.where(chosen >= 0, keys[np.maximum(chosen, 0)], alone)
    return first_window, count, key, content(first_window, first_window + count + window - 1)


PARSED = "_id long, _th long, doc_id long, n_words long, kept_sha256 string, anchors array<struct<at:int,n:int,key:long,body:long>>"


def _parse(window: int):
    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                data, off = flat(part.column("text"))
                begins, ends, first = spans(IS_WORD[data], off)
                at, n, key, body = anchors(word_ids(data, begins, ends), first, window)
                owner = np.searchsorted(first, at, "right") - 1
                raw = data.tobytes()
                shas = [hashlib.sha256(b" ".join(raw[off[i]: off[i + 1]].split())).hexdigest() for i in range(len(off) - 1)]
                rows = pa.StructArray.from_arrays(
                    [pa.array((at - first[owner]).astype(np.int32)), pa.array(n.astype(np.int32)),
                     pa.array(key.view(np.int64)), pa.array(body.view(np.int64))], names=["at", "n", "key", "body"])
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("_th"), part.column("doc_id"), pa.array(np.diff(first)), pa.array(shas, pa.string()),
                     lists(rows, np.searchsorted(owner, np.arange(len(off)), "left"))],
                    names=["_id", "_th", "doc_id", "n_words", "kept_sha256", "anchors"])
    return run


def _windows(window: int):
    """128-bit fingerprints of the listed windows of each text."""
    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                data, off = flat(part.column("text"))
                begins, ends, first = spans(IS_WORD[data], off)
                ask = part.column("ask")
                size = np.diff(ask.offsets.to_numpy())
                values = ask.flatten()
                row = np.repeat(np.arange(len(size)), size)
                n = values.field("n").to_numpy(zero_copy_only=False).astype(np.int64)
                at = values.field("at").to_numpy(zero_copy_only=False).astype(np.int64)
                each = np.repeat(np.arange(len(n)), n)
                step = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
                s = first[row[each]] + at[each] + step
                h = [Ranges(word_ids(data, begins, ends, k), k)(s, s + window).view(np.int64) for k in (0, 1)]
                take = pa.array(row[each])
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id").take(take), part.column("_th").take(take), pa.array(h[0]), pa.array(h[1]),
                     pa.array((at[each] + step).astype(np.int32)), values.field("single").take(pa.array(each))],
                    names=["_id", "_th", "h1", "h2", "at", "single"])
    return run


def _remove(window: int):
    """Words covered by the listed windows [at, at + n) go."""
    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                data, off = flat(part.column("text"))
                begins, ends, first = spans(IS_WORD[data], off)
                hit = part.column("hits")
                size = np.diff(hit.offsets.to_numpy())
                row = np.repeat(np.arange(len(size)), size)
                values = hit.flatten()
                at = first[row] + values.field("at").to_numpy(zero_copy_only=False)
                to = at + values.field("n").to_numpy(zero_copy_only=False) + window - 1
                depth = np.zeros(len(begins) + 1, np.int64)
                np.add.at(depth, at, 1)
                np.add.at(depth, to, -1)
                gone = np.cumsum(depth[:-1]) > 0
                sums = np.concatenate([[0], np.cumsum(gone)])
                raw, texts = data.tobytes(), []
                for i in range(len(size)):
                    keep = np.flatnonzero(~gone[first[i]: first[i + 1]]) + first[i]
                    texts.append(b" ".join([raw[a:b] for a, b in zip(begins[keep].tolist(), ends[keep].tolist(), strict=True)]))
                edge = np.zeros(len(begins) + 1, bool)
                edge[1:-1] = gone[1:] != gone[:-1]
                edge[first] = True
                runs = np.flatnonzero(edge[:-1]) if len(begins) else np.zeros(0, np.int64)
                stops = np.append(runs[1:], len(begins)) if len(runs) else runs
                removed = gone[runs] if len(runs) else np.zeros(0, bool)
                runs, stops = runs[removed], stops[removed]
                owner = np.searchsorted(first, runs, "right") - 1
                spans_ = pa.StructArray.from_arrays([pa.array((x - first[owner]).astype(np.int32)) for x in (runs, stops)], names=["begin", "end"])
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("_th"), pa.array(sums[first[1:]] - sums[first[:-1]]),
                     pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()), pa.array([t.decode() for t in texts], pa.string()),
                     lists(spans_, np.searchsorted(owner, np.arange(len(size) + 1), "left"))],
                    names=["_id", "_th", "n_removed", "sha", "kept_text", "spans"])
    return run


def remove_repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """One row per document row: _id, _th, doc_id, n_words, n_removed, kept_sha256 (kept words joined by one
    space), spans (removed word ranges) and kept_text, null where nothing was removed."""
    rows = docs.select(*row_key(), F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    parsed = cut_lineage(rows.mapInArrow(_parse(window), PARSED), "repeats-parsed", compression="zstd")
    flat_rows = parsed.select("_id", "_th", F.inline("anchors"))
    # Equal strings are counted on the map side before anything is shuffled by key, so a key that a third of the
    # rows have is as many rows as it has different strings.
    bodies = cut_lineage(flat_rows.groupBy("key", "body").agg(F.count("*").alias("c"), F.min(F.struct("_id", "_th", "at", "n")).alias("one")),
                         "repeats-bodies", compression="zstd")
    several = bodies.groupBy("key").agg(F.count("*").alias("k")).filter("k > 1").select("key")
    whole = flat_rows.join(cut_lineage(bodies.filter("c > 1").select("key", "body"), "repeats-whole", compression="zstd"), ["key", "body"], "left_semi") \
        .select("_id", "_th", "at", "n")
    ask = cut_lineage(bodies.join(several, "key", "left_semi").select("one.*", (F.col("c") == 1).alias("single")), "repeats-asked", compression="zstd")
    drop_cut(bodies)
    whole = cut_lineage(whole, "repeats-known", compression="zstd")
    met = whole.select("_id", "_th").unionByName(ask.select("_id", "_th")).distinct()
    texts = cut_lineage(
        rows.drop("doc_id").join(met, ["_id", "_th"], "left_semi").dropDuplicates(["_id", "_th"]),
        "repeats-texts", compression="zstd")
    asked = ask.groupBy("_id", "_th").agg(F.collect_list(F.struct("at", "n", "single")).alias("ask"))
    windows = cut_lineage(texts.join(asked, ["_id", "_th"]).mapInArrow(
        _windows(window), "_id long, _th long, h1 long, h2 long, at int, single boolean"), "repeats-windows", compression="zstd")
    twice = windows.groupBy("h1", "h2").agg(F.count("*").alias("c"), F.max("single").alias("any")).filter("c > 1 and any").select("h1", "h2")
    part = windows.filter("single").join(twice, ["h1", "h2"], "left_semi").select("_id", "_th", "at", F.lit(1).alias("n"))
    hits = cut_lineage(whole.unionByName(part).groupBy("_id", "_th").agg(F.collect_list(F.struct("at", "n")).alias("hits")), "repeats-hits", compression="zstd")
    drop_cut(whole, ask, windows)
    removed = texts.join(hits, ["_id", "_th"]).mapInArrow(
        _remove(window), "_id long, _th long, n_removed long, sha string, kept_text string, spans array<struct<begin:int,end:int>>")
    return parsed.drop("anchors").join(removed, ["_id", "_th"], "left").select(
        "_id", "_th", "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("sha", "kept_sha256").alias("kept_sha256"),
        "spans", "kept_text")


def without_repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """The documents with their repeated windows removed: a changed text is its kept words joined by one space,
    and n_chars, if there, its length.  Other texts and all other columns are as they were."""
    changed = remove_repeats(docs, window).filter("kept_text is not null").select("_id", "_th", "kept_text").dropDuplicates(["_id", "_th"])
    keyed = docs.select(F.struct("*").alias("row"), *row_key()).join(changed, ["_id", "_th"], "left")
    row = F.col("row").withField("text", F.col("kept_text"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length("kept_text").cast(docs.schema["n_chars"].dataType))
    return keyed.select(F.when(F.col("kept_text").isNull(), F.col("row")).otherwise(row).alias("row")).select("row.*")
