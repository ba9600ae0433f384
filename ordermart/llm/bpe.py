"""BPE encoding and decoding with a pair occurrence index (operator 3).

Texts are encoded as the public tokenizer file says: special tokens are cut out, the rest is put in
NFC, lower-cased and split into words by the file's pattern, and each word is merged pair by pair.
The words that a block of a partition holds are merged together: an index maps every adjacent pair
that has a rank to all its positions in the block; the least active rank is applied at all its
positions, left to right, and the lists of the pairs beside them are updated, until no ranked pair is
left.  Each distinct word is merged once in a task and taken from memory after that.

Decoding joins the tokens' strings by spaces, which is what a tokenizer file without a decoder asks
for.  A null text is encoded as an empty one; empty texts have no tokens.  Any other columns pass by
untouched, and empty tables give empty results.
"""

from __future__ import annotations

import heapq
import json
import struct
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.text import pieces

REMEMBER = 300_000  # distinct words kept in a task's memory
BLOCK_BYTES = 2 << 20  # text whose new words are merged together
MANY = 48  # positions from which a rank is applied to all at once
OTHER_SPACE = "\x1c\x1d\x1e\x1f"  # str.split() takes these for spaces, the pattern doesn't


class Vocabulary:
    """The tables of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, self.end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.tokens = {i: t.encode() for t, i in vocab.items()} | {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.word = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        #: (left << 32 | right) -> (rank, merged id)
        self.merges = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.merges.setdefault(vocab[a] << 32 | vocab[b], (rank, vocab[a + b]))
        # byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for 256 and on
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        hidden = [b for b in range(256) if b not in shown]
        letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.inner = np.array([vocab[letter[b]] for b in range(256)])
        self.last = np.array([vocab[letter[b] + self.end] for b in range(256)])
        self.pair = {rank: (key >> 32, key & 0xFFFFFFFF, new) for key, (rank, new) in self.merges.items()}
        #: whether every token is made by a lower rank than any that uses it: merging all places of a rank at once is then exact
        made = {new: rank for rank, (_, _, new) in self.pair.items()}
        self.ordered = len(made) == len(self.pair) and all(max(made.get(a, -1), made.get(b, -1)) < rank for rank, (a, b, _) in self.pair.items())
        keys = sorted(self.merges)
        self.keys, self.key_ranks = np.array(keys, np.int64), np.array([self.merges[k][0] for k in keys], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, -1 where there is none."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_ranks[at], -1)


def merge_words(words: list[bytes], vocab: Vocabulary) -> list[list[int]]:
    """Token ids of each word, by one pair occurrence index over all of them."""
    if not words:
        return []
    size = np.array([len(w) for w in words], np.int64)
    begin = np.cumsum(size) - size
    end = begin + size - 1
    data = np.frombuffer(b"".join(words), np.uint8)
    symbol = vocab.inner[data]
    symbol[end] = vocab.last[data[end]]
    after = np.arange(1, len(data) + 1)  # position of the next symbol of the word, 0 at its end
    after[end] = 0
    before = np.arange(-1, len(data) - 1)  # -1 at its begin
    before[begin] = -1
    places: dict[int, list[int]] = {}

    def index(at: np.ndarray) -> list[int]:
        """Enter the pairs that begin at these positions; the ranks that are new."""
        rank = vocab.rank(symbol[at], symbol[after[at]])
        at, rank = at[rank >= 0], rank[rank >= 0]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        heads = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]])) if len(rank) else rank
        new = []
        at = at.tolist()
        for r, x, y in zip(rank[heads].tolist(), heads.tolist(), np.append(heads, len(rank))[1:].tolist(), strict=True):
            if r in places:
                places[r] += at[x:y]
            else:
                places[r] = at[x:y]
                new.append(r)
        return new

    ranks = index(np.flatnonzero(after))
    heapq.heapify(ranks)
    merges = vocab.merges
    one_symbol, one_after, one_before = memoryview(symbol), memoryview(after), memoryview(before)
    while ranks:
        rank = heapq.heappop(ranks)
        left, right, new = vocab.pair[rank]
        at = places.pop(rank)
        if len(at) >= MANY and left != right and vocab.ordered:
            i = np.sort(np.array(at, np.int64))
            i = i[np.concatenate([[True], i[1:] != i[:-1]])]
            j = after[i]
            here = (symbol[i] == left) & (j > 0) & (symbol[j] == right)  # else another merge has taken a symbol
            i, j = i[here], j[here]
            n = after[j]
            symbol[i], symbol[j], after[i] = new, -1, n
            some = n > 0
            before[n[some]] = i[some]
            p = before[i]
            beside = np.sort(np.concatenate([i[some], p[p >= 0]]))
            for r in index(beside[np.concatenate([[True], beside[1:] != beside[:-1]])[: len(beside)]]):
                heapq.heappush(ranks, r)
            continue
        at.sort()
        for k, i in enumerate(at):
            j = one_after[i]
            if one_symbol[i] != left or not j or one_symbol[j] != right:
                continue
            one_symbol[i], one_symbol[j] = new, -1
            n = one_after[i] = one_after[j]
            p = one_before[i]
            if n:
                one_before[n] = i
            lower = False
            for x, y in ((p, i), (i, n)):
                if x >= 0 and y and (m := merges.get(one_symbol[x] << 32 | one_symbol[y])):
                    r = m[0]
                    if r in places:
                        places[r].append(x)
                    elif r != rank:
                        places[r] = [x]
                        heapq.heappush(ranks, r)
                    else:
                        at.append(x)  # the pair being applied appears again
                    lower |= r < rank
            if lower and k + 1 < len(at):  # a lower rank goes first; this one continues after it
                places[rank] = at[k + 1:] + places.get(rank, [])
                if rank not in ranks:
                    heapq.heappush(ranks, rank)
                break
    ids = symbol[symbol >= 0]
    of = np.concatenate([[0], np.cumsum(symbol >= 0)])
    ids, first, stop = ids.tolist(), of[begin].tolist(), of[end + 1].tolist()
    return [ids[x:y] for x, y in zip(first, stop, strict=True)]


def decode(ids: list[int], vocab: Vocabulary) -> bytes:
    return b" ".join([vocab.tokens[i] for i in ids])


class Coder:
    """Codes blocks of texts; remembers the words of earlier blocks of its task."""

    def __init__(self, path: str):
        self.vocab = Vocabulary(path)
        self.words: dict[str, list[int]] = {}
        self.chunks: dict[str, tuple[bytes, bytes]] = {}

    def normalise(self, text: str) -> list[str]:
        """The chunks between white space of a text without special tokens, normalised."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # character by character, a final capital sigma is none
                text = text.replace("Σ", "σ")
        text = text.lower()
        if any(c in text for c in OTHER_SPACE):
            return [c for c in regex.split(r"\p{White_Space}+", text) if c]
        return text.split()

    def learn(self, chunks: set[str]) -> None:
        if len(self.chunks) + len(chunks) > REMEMBER:
            self.chunks.clear()
            self.words.clear()
        split = {c: self.vocab.word.findall(c) for c in chunks if c not in self.chunks}
        new = [w for w in dict.fromkeys(w for ws in split.values() for w in ws) if w not in self.words]
        self.words.update(zip(new, merge_words([w.encode() for w in new], self.vocab), strict=True))
        known = self.words
        for c, ws in split.items():
            ids = known[ws[0]] if len(ws) == 1 else [i for w in ws for i in known[w]]
            self.chunks[c] = (struct.pack(f"<{len(ids)}I", *ids), decode(ids, self.vocab))

    def code(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """Ids (little-endian unsigned 32-bit) and decoded text of each text."""
        cut = []
        for text in texts:
            if "<|" in text and self.vocab.cut.search(text):
                parts = self.vocab.cut.split(text)
                cut.append((True, [(c, p in self.vocab.special) for p in parts for c in ([p] if p in self.vocab.special else self.normalise(p))]))
            else:
                cut.append((False, self.normalise(text)))
        self.learn(set().union(*(cs if not marked else [c for c, s in cs if not s] for marked, cs in cut)))
        ids, decoded = [], []
        for marked, cs in cut:
            if marked:
                got = [(self.vocab.special[c].to_bytes(4, "little"), c.encode()) if s else self.chunks[c] for c, s in cs]
            else:
                got = [self.chunks[c] for c in cs]
            ids.append(b"".join([x for x, _ in got]))
            decoded.append(b" ".join([y for _, y in got if y]))
        return ids, decoded


def _code(path: str):
    def run(batches):
        coder = Coder(path)
        for batch in batches:
            for part in pieces(batch, size=BLOCK_BYTES):
                ids, decoded = coder.code([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary()).cast(pa.string())],
                                                 names=["doc_id", "ids", "decoded"])
    return run


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit token ids) and decoded (their text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_code(path), "doc_id long, ids binary, decoded string")
