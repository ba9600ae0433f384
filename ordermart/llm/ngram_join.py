"""N-gram Jaccard join by token-combination prefixes (operator 7).

A document's set holds its distinct 5-word shingles (A-Z lower-cased; fewer words: the whole sequence
as one shingle).  Two documents link when 100 * intersection >= percent * union.  Documents with
equal sets form a class; classes are compared by prefix filters that lose no link:

* Two linked sets of n tokens (shingles) or fewer share at least ceil(t n) of them.  If all sets are put in one order and
  index their first n - ceil(t n) + l tokens, linked sets share at least l indexed tokens.
* First all sets are indexed in fingerprint order, which needs no counts.  Sets that share fewer than l
  indexed tokens with all others together are settled; only the others (the live ones) go on.
* The live sets' whole tokens are counted.  A set must share ceil(t n) tokens with other live sets; the
  counts and this test are repeated, as sets drop out.  The rest is indexed in order of frequency, rarest first.
* A token that few sets hold (a rare token) is a key by itself.  Frequent tokens are dealt to
  m = l - 1 classes by fingerprint; l shared ones put two into some class, so the 2-token
  combinations within classes are keys.  m depends on the size band only, and a set joins its own band
  and the next, since linked sizes differ by less than one band.  Keys with equal members count once.
* Each key's members are compared with its most central member (its leader, whose tokens are the most frequent), which
  is linear in the group; keys with one leader are one group.  Then members in other components than that one are compared with the
  others, except where sizes, numbers of shared tokens, and of tokens shared with that member forbid a link.  A group of copies
  never becomes all its pairs.  Whole shingle sets are compared, never sketches.

A token occurs once in a set, so even a group holding a third of all rows gives any one token only a
small share of the index.  Null or empty texts have an empty set, link with nothing and are their own
component.  Repeated rows have equal sets and link.  Only doc_id and text are read.  A component
is named by its least doc_id (null if none of its members has one).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermart.llm.components import components
from ordermart.llm.text import IS_WORD, LOWER, Ranges, flat, mix, pieces, row_key, spans, word_ids
from ordermart.session import cut_lineage, drop_cut

SHINGLE, PERCENT = 5, 80
RARE = 8  # sets that index a rare token, at most
BAND = 1.25  # ratio of successive size bands; 100 / PERCENT at least
SHARE = 0.08  # classes of frequent tokens, as a share of the band's least size
MEMBERS = 500  # members compared with one leader in one task
PIECE_BYTES = 1 << 20  # text whose shingles a task holds at a time


def shingle_sets(part: pa.RecordBatch, k: int = SHINGLE):
    """Distinct shingle fingerprints, ascending within each document, and n + 1 offsets."""
    data, off = flat(part.column("text"))
    lower = LOWER[data]
    begins, ends, first = spans(IS_WORD[data], off)
    content = Ranges(word_ids(lower, begins, ends))
    sizes = np.diff(first)
    count = np.where(sizes >= k, sizes - k + 1, np.minimum(sizes, 1))
    owner = np.repeat(np.arange(len(sizes)), count)
    a = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    token = content(a, np.minimum(a + k, first[owner + 1]))
    order = np.lexsort((token, owner))
    token = token[order]  # owners are in order already
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
    return token[new], np.searchsorted(owner[new], np.arange(len(sizes) + 1))


def classes_of(n: np.ndarray, ahead: int = 0) -> np.ndarray:
    """m of the size band of n tokens, or of the band ``ahead``."""
    return np.floor(SHARE * BAND ** (bands(n) + ahead)).astype(np.int64)


def bands(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(np.maximum(n, 1)) / np.log(BAND) + 1e-9).astype(np.int64)


def _set_names(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    n = np.diff(first).astype(np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(tokens + np.uint64(0x632BE59BD9B4E019)), dtype=np.uint64)])
    return mix(sums[first[1:]] - sums[first[:-1]] + n)


def _info(batches):
    for batch in batches:
        for part in pieces(batch, size=PIECE_BYTES):
            tokens, first = shingle_sets(part)
            yield pa.RecordBatch.from_arrays(
                [part.column("_id"), part.column("_th"), part.column("doc_id"), pa.array(np.diff(first)), pa.array(_set_names(tokens, first).view(np.int64))],
                names=["_id", "_th", "doc_id", "n", "fp"])


def _index(percent: int):
    def run(batches):
        for batch in batches:
            for part in pieces(batch, size=PIECE_BYTES):
                tokens, first = shingle_sets(part)
                n = np.diff(first)
                need = 1 + classes_of(n, 0)  # a set of the band below indexes for at least so many
                size = np.minimum(n, n + (-percent * n) // 100 + 1 + classes_of(n, 1))
                owner = np.repeat(np.arange(len(n)), size)
                at = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens[at].view(np.int64)), pa.array(_set_names(tokens, first).view(np.int64)[owner]),
                     pa.array(n[owner].astype(np.int32)), pa.array(need[owner].astype(np.int32))], names=["tok", "fp", "n", "need"])
    return run


def _tokens(batches):
    for batch in batches:
        for part in pieces(batch, size=PIECE_BYTES):
            tokens, first = shingle_sets(part)
            take = pa.array(np.repeat(np.arange(part.num_rows), np.diff(first)))
            yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), part.column("fp").take(take), part.column("n").take(take)], names=["tok", "fp", "n"])


def _keys(percent: int):
    """Keys of each live set: its rare indexed tokens, and the 2-token combinations of the frequent ones within
    each class, for the set's band and the next.  Tokens that no other set holds come first in the
    order, so of the shared ones live - ceil(t n) + l are indexed."""
    def run(batches):
        for batch in batches:
            toks = batch.column("toks")
            size = np.diff(toks.offsets.to_numpy())
            row = np.repeat(np.arange(len(size)), size)
            c = toks.flatten().field("c").to_numpy()
            tok = toks.flatten().field("tok").to_numpy().view(np.uint64)
            n = batch.column("n").to_numpy().astype(np.int64)
            order = np.lexsort((tok, c, row))
            place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            indexed = place < (size + (-percent * n) // 100 + 1 + classes_of(n, 1))[row]
            c, tok, row = c[order][indexed], tok[order][indexed], row[indexed]
            rare = c <= RARE
            out_key, out_row = [tok[rare]], [row[rare]]
            tok, row = tok[~rare], row[~rare]
            for ahead in (0, 1):
                m = classes_of(n, ahead)[row]
                band = (bands(n) + ahead)[row].astype(np.uint64)
                single = m == 0
                out_key.append(mix(tok[single] ^ mix(band[single] + np.uint64(1))))
                out_row.append(row[single])
                t, r, b, g = tok[~single], row[~single], band[~single], mix(tok[~single]) % np.maximum(m[~single], 1).astype(np.uint64)
                order = np.lexsort((t, g, r))
                t, r, b, g = t[order], r[order], b[order], g[order]
                step = 1
                while step < len(t):
                    same = np.flatnonzero((r[step:] == r[:-step]) & (g[step:] == g[:-step]))
                    if not len(same):
                        break
                    out_key.append(mix(mix(t[same] + b[same] * np.uint64(0x9E3779B97F4A7C15)) + t[same + step] * np.uint64(0xD1342543DE82EF95)))
                    out_row.append(r[same])
                    step += 1
            take = pa.array(np.concatenate(out_row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(out_key).view(np.int64)), *(batch.column(x).take(take) for x in ("fp", "n", "live", "central"))],
                names=["key", "fp", "n", "live", "central"])
    return run


def _compare(percent: int):
    """Rows sorted by (a, salt, role): a leader's text, then its members' texts."""
    def run(batches):
        leader, own = None, None
        for batch in batches:
            for part in pieces(batch, size=PIECE_BYTES):
                tokens, first = shingle_sets(part)
                a, role, fp = (part.column(c).to_numpy(zero_copy_only=False) for c in ("a", "role", "fp"))
                out = []
                for i in range(len(a)):
                    mine = tokens[first[i]: first[i + 1]]
                    if role[i] == 0:
                        leader, own = a[i], mine
                    else:
                        assert leader == a[i]
                        both = len(np.intersect1d(own, mine, assume_unique=True))
                        out.append((a[i], fp[i], both, 100 * both >= percent * (len(own) + len(mine) - both)))
                columns = list(zip(*out, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.bool_()), strict=True)],
                                                 names=["a", "b", "both", "linked"])
    return run


def _compared(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with the number of tokens in both whole sets, and whether they link.  Each
    member's text travels once a leader."""
    salt = F.pmod(F.xxhash64("b"), F.greatest(F.lit(1), F.ceil(F.count("*").over(Window.partitionBy("a")) / MEMBERS)))
    salted = pairs.select("a", "b", salt.cast("int").alias("salt"))
    rows = salted.select("a", "salt", F.lit(1).alias("role"), F.col("b").alias("fp")).unionByName(
        salted.select("a", "salt", F.lit(0).alias("role"), F.col("a").alias("fp")).distinct())
    dealt = rows.join(texts, "fp").repartition("a", "salt").sortWithinPartitions("a", "salt", "role")
    return dealt.select("a", "role", "fp", "text").mapInArrow(_compare(percent), "a long, b long, both long, linked boolean")


def _possible(percent: int) -> Column:
    """Whether sets a and b (sizes an, bn; tokens shared with any other set: al, bl) can link."""
    return F.expr(f"100 * least(an, bn) >= {percent} * greatest(an, bn) and {100 + percent} * least(al, bl) >= {percent} * (an + bn)")


def links(docs: DataFrame, percent: int = PERCENT, made: list | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(info, edges, labels): a row per document row (_id, _th, doc_id, n, fp: its set's class), verified
    links between classes that span every component, and the component (node, component) of linked classes.
    Tables that only a step reads are deleted after it; the others are added to ``made``."""
    made = [] if made is None else made
    rows = docs.select(*row_key(), F.col("doc_id").cast("long").alias("doc_id"), "text")
    info = cut_lineage(rows.mapInArrow(_info, "_id long, _th long, doc_id long, n long, fp long"), "ngram-sets", compression="zstd")
    counted = lambda df: df.withColumn("c", F.count("*").over(Window.partitionBy("tok"))).filter("c > 1")

    def enough(df, need):
        own = df.groupBy("fp", *need).agg(F.count("*").alias("x")).filter(f"x >= {need[-1]}" if need[-1] == "need" else f"100 * x >= {percent} * n")
        return df.join(own.select("fp"), "fp", "left_semi")

    # fingerprint order
    index = rows.select("text").mapInArrow(_index(percent), "tok long, fp long, n int, need int").repartition("tok") \
        .groupBy("tok", "fp").agg(F.first("need").alias("need"))
    whole = cut_lineage(counted(index), "ngram-index", compression="zstd")
    first = cut_lineage(counted(enough(whole.drop("c"), ["need"])), "ngram-live", compression="zstd")
    drop_cut(whole)
    live = enough(first, ["need"]).select("fp").distinct()
    one = live.join(info.groupBy("fp").agg(F.min(F.struct("_id", "_th")).alias("one"), F.first("n").cast("int").alias("n")), "fp").select("fp", "n", "one.*")
    texts = cut_lineage(rows.drop("doc_id").join(one, ["_id", "_th"]).select("fp", "n", "text").dropDuplicates(["fp"]), "ngram-texts", compression="zstd")
    drop_cut(first)
    # frequency order
    every = cut_lineage(enough(counted(texts.mapInArrow(_tokens, "tok long, fp long, n int")), ["n"]), "ngram-tokens", compression="zstd")
    kept = cut_lineage(enough(counted(every.drop("c")), ["n"]), "ngram-kept", compression="zstd")
    drop_cut(every)
    sets = kept.groupBy("fp", "n").agg(F.collect_list(F.struct("c", "tok")).alias("toks"), F.count("*").alias("live"), (F.sum("c") / F.col("n")).alias("central"))
    keys = cut_lineage(sets.mapInArrow(_keys(percent), "key long, fp long, n int, live long, central double").distinct(), "ngram-keys", compression="zstd")
    drop_cut(kept)
    groups = keys.groupBy("key").agg(F.count("*").alias("members"), F.expr("bit_xor(xxhash64(fp))").alias("x"), F.expr("bit_xor(xxhash64(fp, 1))").alias("y"),
                                     F.max(F.struct("central", "fp", "n", "live")).alias("leader")).filter("members > 1")
    groups = groups.groupBy("members", "x", "y").agg(F.min(F.struct("key", "leader")).alias("g")).select("g.*")
    # keys with one leader are one group
    members = cut_lineage(keys.join(groups, "key").select("leader", "fp", "n", "live").distinct(), "ngram-groups", compression="zstd")
    drop_cut(keys)
    pairs = cut_lineage(members.select(F.col("leader.fp").alias("a"), F.col("leader.n").alias("an"), F.col("leader.live").alias("al"),
                                       F.col("fp").alias("b"), F.col("n").alias("bn"), F.col("live").alias("bl"))
                        .filter("a <> b").filter(_possible(percent)).select("a", "b").distinct(), "ngram-pairs")
    stars = cut_lineage(_compared(pairs, texts, percent), "ngram-stars")
    edges = stars.filter("linked").select("a", "b")
    # members that no link joins with their leader so far; one that shares too few tokens for the group's least set is done
    label = components(edges)
    led = members.select(F.col("leader.fp").alias("lead"), "fp", "n", "live")
    named = led.join(label, F.col("fp") == label["node"], "left").select("lead", "fp", "n", "live", F.coalesce("component", "fp").alias("part")).join(
        stars.select(F.col("a").alias("lead"), F.col("b").alias("fp"), "both"), ["lead", "fp"], "left")
    # of a member's shared tokens, so many are the leader's (at most) and so many are not
    named = named.select("lead", "fp", "n", "live", "part", F.coalesce("both", F.col("live")).alias("with"),
                         F.when(F.col("both").isNull(), F.col("live")).otherwise(F.col("live") - F.col("both")).alias("without"))
    main = led.groupBy("lead").agg(F.min("n").alias("least")).join(label, F.col("lead") == label["node"], "left").select(
        "lead", "least", F.coalesce("component", "lead").alias("main"))
    named = cut_lineage(named.join(main, "lead"), "ngram-parts")
    apart = named.filter("part <> main").filter(f"{100 + percent} * live >= {percent} * (n + least)")
    side = lambda df, x: df.select("lead", *[F.col(c).alias(f"{x}{y}") for c, y in (
        ("fp", ""), ("n", "n"), ("live", "l"), ("part", "p"), ("with", "w"), ("without", "o"))], *(["main"] if x == "b" else []))
    shared_most = f"{100 + percent} * (least(aw, bw) + least(ao, bo)) >= {percent} * (an + bn)"
    rest = side(apart, "a").join(side(named, "b"), "lead").filter("ap <> bp and (bp = main or a < b)").filter(_possible(percent)).filter(
        shared_most).select("a", "b").distinct()
    done = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rest = cut_lineage(rest.join(done, ["a", "b"], "left_anti"), "ngram-rest")
    more = cut_lineage(_compared(rest, texts, percent), "ngram-more")
    drop_cut(texts, members, named, rest)
    made += [info, pairs, stars, more]
    more = more.filter("linked").select("a", "b")
    if more.isEmpty():
        return info, edges, label
    edges = edges.unionByName(more)
    return info, edges, components(edges)


def near_duplicates(docs: DataFrame, percent: int = PERCENT, made: list | None = None) -> DataFrame:
    """One row per document row: _id, _th, doc_id, n_shingles, component_id and component (null for an empty set).
    ``made``: gets the tables that the result reads."""
    info, _, label = links(docs, percent, made)
    named = info.join(label, info["fp"] == label["node"], "left").select(
        "_id", "_th", "doc_id", "n", "fp", F.coalesce("component", "fp").alias("component"))
    least = named.filter("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    full = named.filter("n > 0").join(least, "component").select("_id", "_th", "doc_id", F.col("n").alias("n_shingles"), "component_id", "component")
    empty = named.filter("n = 0").select("_id", "_th", "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("component"))
    return full.unionByName(empty)


def representatives(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents, of each component only one: that with the least doc_id (of equal ids, the least
    text fingerprint).  Documents without words all stay.  All columns are kept."""
    made = []
    found = near_duplicates(docs, percent, made)
    linked = found.filter("component is not null")
    least = linked.groupBy("component").agg(F.min(F.struct("_id", "_th")).alias("one"), F.count("*").alias("rows"))
    # a component of one row is kept as it is; of others only the least row's key is, and its repeated rows are one
    groups = cut_lineage(linked.select("_id", "_th", "component").join(least.filter("rows > 1"), "component")
                         .select("_id", "_th", (F.struct("_id", "_th") == F.col("one")).alias("first")).distinct(), "ngram-rows")
    drop_cut(*made)
    keyed = docs.select(F.struct("*").alias("row"), *row_key()).join(groups, ["_id", "_th"], "left")
    alone = keyed.filter("first is null").select("row.*")
    return alone.unionByName(keyed.filter("first").dropDuplicates(["_id", "_th"]).select("row.*"))
