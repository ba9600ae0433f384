"""Suffix-array dedup by external induced sorting (operator 8).

A text is its UTF-8 bytes; every byte covered by a 200-byte string that also starts anywhere else, same
document included, is removed; strings are judged on the input and don't cross documents.

1. Which strings can repeat: each window of 200 bytes picks an anchor, a content-defined symbol in it (tokens end
   where the bytes before say so; the symbols are runs and pairs of tokens, see
   ``substring_dedup``), so equal windows pick equal keys at equal offsets.  Windows with one pick form a row.
   Rows whose key occurs once are settled: their windows don't repeat.
2. Rows with equal bytes are one string that repeats as a whole.  Where a key has different strings, one copy
   of each goes to the shard of its key; equal windows have equal keys, so they meet in one shard.
3. Each task puts its shard on disk and sorts its suffixes by external induced sorting
   (``induced_sort``): disk-backed priority queues carry suffix tuples and common prefixes.  A
   suffix that shares 200 bytes with a neighbour begins a repeated window.
4. Each document's repeated windows are merged into spans, and their bytes are removed.

Null texts are empty; texts below 200 bytes stay whole.  Repeated rows are documents of their own (their windows repeat
each other).  Only doc_id and text are read; empty tables give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm import induced_sort
from ordermart.llm.substring_dedup import choose, recompress
from ordermart.llm.text import IS_WORD, Ranges, flat, lists, mix, pieces, row_key
from ordermart.session import cut_lineage, drop_cut

WINDOW = 200
ROUNDS = 1
SHARD_BYTES = 1 << 20  # strings sorted by one task, up to so many tasks; beyond, shards grow
MOST_SHARDS = 10_000
TOKEN = 64  # bytes between ends by fingerprint, on average
CONTEXT = 4  # bytes that decide whether a token ends after them, at most
_U = np.uint64
_BYTES = mix(np.arange(5, 261, dtype=_U) * _U(0x9E3779B97F4A7C15))


def tokens(data: np.ndarray, off: np.ndarray):
    """(begins, ends, first tokens) of the documents' tokens: one ends after the first space that follows a
    word, or where the four bytes before have a rare fingerprint, for texts with few spaces; and whether each
    document's end is such a place too."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n >= CONTEXT:
        word = IS_WORD[data]
        cut[2:] = word[:-1] & ~word[1:]
        four = np.lib.stride_tricks.as_strided(data, (n - CONTEXT + 1, CONTEXT), (1, 1)).copy().view(np.uint32)[:, 0]
        h = four * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA77)
        cut[CONTEXT:] |= (h >> np.uint32(8)) < np.uint32((1 << 24) // TOKEN)
    closed = cut[off[1:]] & (off[1:] - off[:-1] >= CONTEXT)  # before an empty document clears the end of the one before
    for k in range(1, CONTEXT):  # what decides lies within one document
        cut[np.minimum(off[:-1] + k, off[1:])] = False
    cut[off] = True
    edges = np.flatnonzero(cut)
    return edges[:-1], edges[1:], np.searchsorted(edges, off), closed


def picked(a: np.ndarray, b: np.ndarray, keys: np.ndarray, low: np.ndarray, high: np.ndarray, window: int):
    """Window intervals [a, b), each of one document, cut where the symbols within a window change.

    Returns the runs of windows with one pick (begin, end, picked symbol) and the intervals without any."""
    s = np.sort(np.concatenate([a, low + 1, high - window]), kind="stable")
    s = s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s
    of = np.searchsorted(a, s, "right") - 1
    valid = (of >= 0) & (s < b[np.maximum(of, 0)]) if len(a) else np.zeros(len(s), bool)
    s, of = s[valid], of[valid]
    if not len(s):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    e = np.minimum(np.append(s[1:], b[-1]), b[of])
    lo, hi = np.searchsorted(low, s, "left"), np.searchsorted(high, s + window, "right") - 1
    some = hi >= lo
    pick = choose(keys, lo[some], hi[some]) if some.any() else np.zeros(0, np.int64)
    without = s[~some], e[~some]
    if not some.any():  # one long run, such as of spaces or of unspaced characters: no symbol of this level
        return s[:0], s[:0], s[:0], *without
    s, e, of = s[some], e[some], of[some]
    start = np.ones(len(s), bool)
    start[1:] = (pick[1:] != pick[:-1]) | (s[1:] != e[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(start)
    last = np.append(at[1:], len(s)) - 1
    return s[at], e[last], pick[at], *without


def anchors(data: np.ndarray, off: np.ndarray, window: int = WINDOW):
    """Rows (first window, number of windows, key, fingerprint) as in ``substring_dedup.anchors``, in bytes, and
    runs (first window, number of windows) that repeat within their document for sure.

    A window that holds no high symbol, because it lies in two long runs, picks among the places where unequal
    tokens meet; one without these (in periodic text, or among very long tokens) is its own key, and
    of equal ones in a document two rows stand for all."""
    content = Ranges(_BYTES[data])
    begins, ends, first, closed = tokens(data, off)
    sizes = np.diff(first)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    low, high = begins - CONTEXT, ends.copy()
    filled = sizes > 0
    low[first[:-1][filled]] = off[:-1][filled] - 1  # a document's begin and end aren't marked in a window
    high[first[1:][filled] - 1] += ~closed[filled]
    token = content(begins, ends)
    name, high_low, high_high = recompress(token, low, high, doc, off[:-1] - 1, off[1:] + 1, ROUNDS)
    meet = np.flatnonzero((doc[1:] == doc[:-1]) & (token[1:] != token[:-1]))

    def keyed(name, low, high):
        inside = (low >= 0) & (high <= len(data))
        return mix(name + content(np.where(inside, low, 0), np.where(inside, high, 0))), low, high

    stop = np.maximum(off[1:] - window + 1, off[:-1])
    some = stop > off[:-1]
    levels = (keyed(name, high_low, high_high), keyed(mix(token[meet] + _U(7)), low[meet], high[meet + 1]))
    a, b, rows = off[:-1][some], stop[some], []
    for keys, below, above in levels:
        s, e, pick, a, b = picked(a, b, keys, below, above, window)
        rows.append((s, e - s, keys[pick], content(s, e + window - 1)))
    # windows one by one
    count = b - a
    single = np.repeat(a - (np.cumsum(count) - count), count) + np.arange(count.sum())
    own = content(single, single + window)
    doc = np.searchsorted(off, single, "right") - 1
    order = np.lexsort((single, own, doc))
    first_of = np.ones(len(order), bool)
    first_of[1:] = (own[order][1:] != own[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    place = np.arange(len(order)) - np.maximum.accumulate(np.where(first_of, np.arange(len(order)), 0))
    twice = place > 0
    twice[:-1] |= place[1:] > 0
    kept = order[place < 2]
    rows.append((single[kept], np.ones(len(kept), np.int64), mix(own[kept] ^ _U(0x8EBC6AF09C88C6E3)), own[kept]))
    sure, whose = single[np.sort(order[twice])], doc[np.sort(order[twice])]
    new = np.ones(len(sure), bool)
    new[1:] = (sure[1:] != sure[:-1] + 1) | (whose[1:] != whose[:-1])
    runs = np.flatnonzero(new)
    out = [np.concatenate(x) for x in zip(*rows, strict=True)]
    order = np.argsort(out[0], kind="stable")
    return tuple(x[order] for x in out), (sure[runs], np.diff(np.append(runs, len(sure))))


PARSED = "_id long, _th long, doc_id long, n_bytes long, sha string, anchors array<struct<at:int,n:int,key:long,body:long>>, sure array<struct<at:int,n:int>>"


def _parse(window: int):
    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                data, off = flat(part.column("text"))
                (at, n, key, body), (sure, many) = anchors(data, off, window)
                whose = np.searchsorted(off, sure, "right") - 1
                owner = np.searchsorted(off, at, "right") - 1
                raw = data.tobytes()
                rows = pa.StructArray.from_arrays(
                    [pa.array((at - off[owner]).astype(np.int32)), pa.array(n.astype(np.int32)),
                     pa.array(key.view(np.int64)), pa.array(body.view(np.int64))], names=["at", "n", "key", "body"])
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("_th"), part.column("doc_id"), pa.array(np.diff(off)),
                     pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)], pa.string()),
                     lists(rows, np.searchsorted(owner, np.arange(len(off)), "left")),
                     lists(pa.StructArray.from_arrays([pa.array((sure - off[whose]).astype(np.int32)), pa.array(many.astype(np.int32))], names=["at", "n"]),
                           np.searchsorted(whose, np.arange(len(off)), "left"))],
                    names=["_id", "_th", "doc_id", "n_bytes", "sha", "anchors", "sure"])
    return run


def _strings(window: int):
    """The listed rows' bytes, each with its key and place."""
    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                data, off = flat(part.column("text"))
                ask = part.column("ask")
                size = np.diff(ask.offsets.to_numpy())
                row = np.repeat(np.arange(len(size)), size)
                values = ask.flatten()
                at, n = (values.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "n"))
                a = off[row] + at
                raw = data.tobytes()
                out = [raw[x:y] for x, y in zip(a.tolist(), (a + n + window - 1).tolist(), strict=True)]
                take = pa.array(row)
                step = 1 << 14
                whole = pa.RecordBatch.from_arrays(
                    [values.field("key"), part.column("_id").take(take), part.column("_th").take(take), values.field("at"), values.field("single"), pa.array(out, pa.binary())],
                    names=["key", "_id", "_th", "at", "single", "bytes"])
                for i in range(0, whole.num_rows, step):
                    yield whole.slice(i, step)
    return run


def _sort_shard(window: int):
    """A shard's strings to disk, then the runs of their windows that begin elsewhere too."""
    def run(batches):
        with induced_sort.Folder() as folder:
            name, places, sizes, total = folder.name(), folder.name(), [], 0
            with open(name, "wb") as f, pa.OSFile(places, "wb") as g:
                writer = None
                for batch in batches:
                    data, off = flat(batch.column("bytes"))
                    symbols = np.zeros(len(data) + len(off) - 1, np.uint16)
                    symbols[np.arange(len(data)) + np.repeat(np.arange(len(off) - 1), np.diff(off))] = data.astype(np.uint16) + 1
                    f.write(symbols.tobytes())
                    place = batch.select(["_id", "_th", "at", "single"])
                    writer = writer or pa.ipc.new_stream(g, place.schema)
                    writer.write_batch(place)
                    sizes.append((np.diff(off) + 1).astype(np.int64))
                    total += len(symbols)
                if writer is None:
                    return
                writer.close()
            text = np.memmap(name, np.uint16, "r")
            again, last = folder.array(np.bool_, total), None
            for at, lcp in induced_sort.sorted_suffixes(text, window, folder):
                twin = lcp >= window
                again[at[twin]] = True
                if twin[0]:
                    again[last] = True
                again[at[:-1][twin[1:]]] = True
                last = int(at[-1])
            begin, reader = 0, pa.ipc.open_stream(pa.memory_map(places))
            for place, size in zip(reader, sizes, strict=True):
                off = np.concatenate([[0], np.cumsum(size)])
                hit = np.asarray(again[begin: begin + off[-1]])
                begin += off[-1]
                opens = hit & ~np.concatenate([[False], hit[:-1]])
                closes = hit & ~np.append(hit[1:], False)
                a, b = np.flatnonzero(opens), np.flatnonzero(closes) + 1  # a string's last window ends before its end
                row = np.searchsorted(off, a, "right") - 1
                out = pa.RecordBatch.from_arrays(
                    [place.column("_id").take(pa.array(row)), place.column("_th").take(pa.array(row)),
                     pa.array((place.column("at").to_numpy()[row] + a - off[row]).astype(np.int32)), pa.array((b - a).astype(np.int32))], names=["_id", "_th", "at", "n"])
                yield out.filter(place.column("single").take(pa.array(row)))
    return run


def _remove(window: int):
    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                data, off = flat(part.column("text"))
                hit = part.column("hits")
                size = np.diff(hit.offsets.to_numpy())
                row = np.repeat(np.arange(len(size)), size)
                values = hit.flatten()
                at = off[row] + values.field("at").to_numpy(zero_copy_only=False)
                depth = np.zeros(len(data) + 1, np.int64)
                np.add.at(depth, at, 1)
                np.add.at(depth, at + values.field("n").to_numpy(zero_copy_only=False) + window - 1, -1)
                gone = np.cumsum(depth[:-1]) > 0
                before, after = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
                before[1:], after[:-1] = gone, gone
                before[off], after[off] = False, False
                a, b = np.flatnonzero(gone & ~before[:-1]), np.flatnonzero(gone & ~after[1:]) + 1
                owner = np.searchsorted(off, a, "right") - 1
                of = np.searchsorted(owner, np.arange(len(size) + 1), "left")
                kept = [data[x:y][~gone[x:y]].tobytes() for x, y in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                removed = np.concatenate([[0], np.cumsum(gone)])
                spans = pa.StructArray.from_arrays([pa.array((x - off[owner]).astype(np.int32)) for x in (a, b)], names=["begin", "end"])
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("_th"), pa.array(removed[off[1:]] - removed[off[:-1]]),
                     pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()), lists(spans, of), pa.array(kept, pa.binary())],
                    names=["_id", "_th", "n_removed", "kept", "spans", "kept_bytes"])
    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document row: doc_id, n_bytes, n_removed, spans (removed byte ranges), kept_sha256 and
    kept_bytes, null where nothing was removed."""
    rows = docs.select(*row_key(), F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    parsed = cut_lineage(rows.mapInArrow(_parse(window), PARSED), "suffix-parsed", compression="zstd")
    flat_rows = parsed.select("_id", "_th", F.inline("anchors"))
    # Equal strings are counted on the map side before anything is shuffled by key, so a key that a third of the
    # rows have is as many rows as it has different strings.  Any row of equal strings stands for all: the first one's
    # columns, which always come from the same row and, unlike the least struct, need no sort.
    place = ["_id", "_th", "at", "n"]
    bodies = cut_lineage(flat_rows.groupBy("key", "body").agg(F.count("*").alias("c"), *(F.first(c).alias(c) for c in place)),
                         "suffix-bodies", compression="zstd")
    several = bodies.groupBy("key").agg(F.count("*").alias("k")).filter("k > 1").select("key")
    ask = cut_lineage(bodies.join(several, "key", "left_semi").select("key", *place, (F.col("c") == 1).alias("single")), "suffix-asked", compression="zstd")
    known = cut_lineage(bodies.filter("c > 1").select("key", "body"), "suffix-known", compression="zstd")
    drop_cut(bodies)
    whole = cut_lineage(flat_rows.join(known, ["key", "body"], "left_semi").select("_id", "_th", "at", "n"), "suffix-whole", compression="zstd")
    met = whole.select("_id", "_th").unionByName(ask.select("_id", "_th")).distinct()
    texts = cut_lineage(rows.drop("doc_id").join(met, ["_id", "_th"], "left_semi").dropDuplicates(["_id", "_th"]), "suffix-texts", compression="zstd")
    asked = ask.groupBy("_id", "_th").agg(F.collect_list(F.struct("key", "at", "n", "single")).alias("ask"))
    strings = texts.join(asked, ["_id", "_th"]).mapInArrow(_strings(window), "key long, _id long, _th long, at int, single boolean, bytes binary")
    # A task's scratch files are some 15 times its shard; each step is written before the next, so that its shuffles can go.
    spark = docs.sparkSession
    size = ask.agg(F.sum(F.col("n") + F.lit(window - 1))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_SHARDS, -(-size // SHARD_BYTES)))
    part = cut_lineage(strings.repartition(shards, "key").select("_id", "_th", "at", "single", "bytes")
                       .mapInArrow(_sort_shard(window), "_id long, _th long, at int, n int"), "suffix-runs", compression="zstd")
    sure = parsed.filter("size(sure) > 0").dropDuplicates(["_id", "_th"]).select("_id", "_th", F.inline("sure"))
    hits = cut_lineage(whole.unionByName(part).unionByName(sure).groupBy("_id", "_th").agg(F.collect_list(F.struct("at", "n")).alias("hits")),
                       "suffix-hits", compression="zstd")
    drop_cut(whole, ask, known, part)
    removed = texts.join(hits, ["_id", "_th"]).mapInArrow(
        _remove(window), "_id long, _th long, n_removed long, kept string, spans array<struct<begin:int,end:int>>, kept_bytes binary")
    return parsed.drop("anchors", "sure").join(removed, ["_id", "_th"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("kept", "sha").alias("kept_sha256"), "spans", "kept_bytes")
