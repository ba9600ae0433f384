"""Language identification by cross-parsing (operator 10).

A suffix automaton for each language holds all substrings of its training text.  A document is parsed
greedily against each automaton: from a place, the longest match in the language's text is one
phrase, and the next phrase begins after it.  Parsing starts anew at each word, so a word's phrase
count is looked up once and remembered.  The language that needs the fewest phrases per letter wins;
of equals, the first by name.  The score is the margin to the runner-up, 1 - fewest / second (1 if one
language is learned).

Training takes labelled documents that are not held out: of each language about ``TRAIN_DOCS`` distinct texts
by fingerprint (copies don't crowd it), which give ``TRAIN_CHARS`` characters together at most.  Short texts
are taken whole, longer ones give their first characters in equal parts, so no text is learned from alone while
there are others.  This bounds the training only: the prediction reads nothing but the text, all of it.

Null texts and texts without a letter are ``und`` with score 0, as is everything when nothing can be
learned.  A null doc_id is not held out.  Repeated rows are judged alike; only doc_id, text and lang are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermart.llm.text import pieces, release

TRAIN_CHARS = 100_000  # of training text a language, at most
TRAIN_DOCS = 400  # distinct documents that training draws from a language, about
REMEMBER = 200_000
PIECE_BYTES = 1 << 20  # text whose words are held at a time
UNKNOWN = "und"
HELD_OUT = 2
LETTERS = regex.compile(r"\p{L}+")


def held_out(doc_id: Column | str = "doc_id") -> Column:
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def shares(sizes: list[int], chars: int) -> list[int]:
    """Characters that texts of these sizes give, ``chars`` together at most: all of the short ones, equal parts of the others."""
    out, left = [0] * len(sizes), chars
    for done, i in enumerate(sorted(range(len(sizes)), key=sizes.__getitem__)):
        out[i] = min(sizes[i], left // (len(sizes) - done))
        left -= out[i]
    return out


def training_texts(docs: DataFrame, chars: int = TRAIN_CHARS, sample: int = TRAIN_DOCS) -> dict[str, list[str]]:
    """Bounded training texts by language."""
    spark = docs.sparkSession
    rows = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("text").alias("h"))
    distinct = rows.select("lang", "h", F.length("text").alias("size")).distinct()
    counts = {r.lang: r.n for r in distinct.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    # a row for each language learned, whose automaton every task holds anyway
    known = F.broadcast(spark.createDataFrame(list(counts.items()), "lang string, n long"))
    part = F.col("h") / F.lit(2.0**64) + 0.5
    drawn = {lang: [] for lang in counts}
    for r in distinct.join(known, "lang").filter(part * F.col("n") <= sample).toLocalIterator():
        drawn[r.lang].append((r.h, r["size"]))
    for lang in [x for x, few in drawn.items() if not few]:  # a language so small that the sample missed it
        drawn[lang] = [(r.h, r["size"]) for r in distinct.filter(F.col("lang") == lang).orderBy("h").limit(sample).collect()]
    given = [(lang, h, n) for lang, few in drawn.items() for (h, _), n in zip(few, shares([size for _, size in few], chars), strict=True)]
    # about ``sample`` rows a language
    asked = F.broadcast(spark.createDataFrame(given, "lang string, h long, given int"))
    chosen = rows.join(asked, ["lang", "h"]).select("lang", "h", F.expr("substring(text, 1, given)").alias("text")).dropDuplicates(["lang", "h"])
    out = {lang: [] for lang in counts}
    for r in chosen.orderBy("lang", "h").toLocalIterator():
        out[r.lang].append(r.text)
    return out


class Words:
    """Words as one array of code points, in order of length, the longest first."""

    def __init__(self, words: list[str]):
        size = np.array([len(w) for w in words], np.int64)
        self.order = np.argsort(-size, kind="stable")
        self.size = size[self.order]
        self.begin = (np.cumsum(size) - size)[self.order]
        self.codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.longer = np.searchsorted(-self.size, -np.arange(int(size.max(initial=0))), "left")


class Automaton:
    """The suffix automaton of a text, its moves as one sorted array (three for each character at most)."""

    def __init__(self, text: str):
        self.letters = {c: i for i, c in enumerate(sorted(set(text)))}
        links, lengths, moves = [-1], [0], [{}]
        last = 0
        for c in map(self.letters.__getitem__, text):
            here = len(moves)
            links.append(0)
            lengths.append(lengths[last] + 1)
            moves.append({})
            p = last
            while p >= 0 and c not in moves[p]:
                moves[p][c] = here
                p = links[p]
            if p >= 0:
                q = moves[p][c]
                if lengths[q] == lengths[p] + 1:
                    links[here] = q
                else:
                    copy = len(moves)
                    links.append(links[q])
                    lengths.append(lengths[p] + 1)
                    moves.append(moves[q].copy())
                    while p >= 0 and moves[p].get(c) == q:
                        moves[p][c] = copy
                        p = links[p]
                    links[q] = links[here] = copy
            last = here
        self.width = max(len(self.letters), 1)
        n = sum(map(len, moves))
        self.moves = np.fromiter((state * self.width + c for state, out in enumerate(moves) for c in sorted(out)), np.int64, n)
        self.to = np.fromiter((out[c] for out in moves for c in sorted(out)), np.int32, n)
        self.root = self.to[:len(moves[0])].astype(np.int64)  # each letter leaves the first state

    def step(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The states after a letter, -1 where there is none."""
        out = np.full(len(state), -1, np.int64)
        live = np.flatnonzero((state >= 0) & (letter >= 0))
        move = state[live] * self.width + letter[live]
        at = np.searchsorted(self.moves, move)
        at[at == len(self.moves)] = 0
        found = self.moves[at] == move if len(self.moves) else np.zeros(0, bool)
        out[live[found]] = self.to[at[found]]
        return out

    def phrases(self, words: Words) -> np.ndarray:
        """Longest matches that a greedy parse of each word takes; an unknown letter is one.  All words step at once."""
        number = np.full(0x110000, -1, np.int32)
        number[[ord(c) for c in self.letters]] = list(self.letters.values())
        letter = number[words.codes]
        n, state = np.zeros(len(words.size), np.int64), np.full(len(words.size), -1, np.int64)
        for j in range(int(words.size.max(initial=0))):
            m = words.longer[j]  # words are in order of length, the longest first
            k = letter[words.begin[:m] + j].astype(np.int64)
            to = self.step(state[:m], k)
            ended = to < 0
            n[:m] += ended
            begun = np.flatnonzero(ended & (k >= 0))
            to[begun] = self.root[k[begun]]
            state[:m] = to
        out = np.empty_like(n)
        out[words.order] = n
        return out


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def train(texts: dict[str, list[str]]) -> dict[str, Automaton]:
    return {lang: Automaton(" " + " ".join(w for t in ts for w in words_of(t)) + " ") for lang, ts in sorted(texts.items())}


class Predictor:
    """Predicts blocks of texts; remembers the phrase counts of earlier blocks' words."""

    def __init__(self, automata: dict[str, Automaton]):
        self.langs, self.automata = list(automata), list(automata.values())
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.counts = np.zeros((0, len(self.langs) + 1), np.int64)  # phrases by language, letters

    def learn(self, chunks: list[str]) -> None:
        words, owner, letters = [], [], []
        for i, c in enumerate(chunks):
            own = words_of(c)
            words += [f" {w} " for w in own]
            owner += [i] * len(own)
            letters.append(sum(map(len, own)))
        several = Words(words)
        rows = np.zeros((len(chunks), len(self.langs) + 1), np.int64)
        for k, a in enumerate(self.automata):
            np.add.at(rows[:, k], owner, a.phrases(several))
        rows[:, -1] = letters
        self.number.update(zip(chunks, range(len(self.number), len(self.number) + len(chunks)), strict=True))
        self.counts = np.concatenate([self.counts, rows])

    def predict(self, texts: list) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, phrases a letter) of each text."""
        if len(self.number) > REMEMBER:
            self.forget()
        chunks = [(t or "").split() for t in texts]
        self.learn(list(set().union(*chunks).difference(self.number)))
        total = np.zeros((len(chunks), len(self.langs) + 1), np.int64)
        for i, cs in enumerate(chunks):
            if cs:
                total[i] = self.counts[list(map(self.number.__getitem__, cs))].sum(axis=0)
        letters, phrases = total[:, -1], total[:, :-1]
        some = (letters > 0) & (len(self.langs) > 0)
        if not self.langs:
            return [UNKNOWN] * len(chunks), np.zeros(len(chunks)), np.zeros(len(chunks))
        least = np.sort(phrases, axis=1)[:, :2].astype(float)
        score = 1 - least[:, 0] / np.maximum(least[:, 1], 1) if len(self.langs) > 1 else np.ones(len(chunks))
        names = [self.langs[b] if s else UNKNOWN for b, s in zip(phrases.argmin(axis=1).tolist(), some.tolist(), strict=True)]
        return names, np.where(some, score, 0.0), np.where(some, least[:, 0] / np.maximum(letters, 1), 0.0)


def _predict(model):
    def run(batches):
        predictor = Predictor(model.value)
        for batch in batches:
            for part in pieces(batch, size=PIECE_BYTES):
                langs, score, rate = predictor.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(langs, pa.string()), pa.array(score), pa.array(rate)],
                                                 names=["doc_id", "lang_pred", "score", "phrases_a_letter"])
    return run


def _known(model, index: int):
    def run(batches):
        predictor = Predictor(model.value)
        for batch in batches:
            batch = batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])
            for part in pieces(batch, f"c{index}", PIECE_BYTES):
                langs, _, _ = predictor.predict(part.column(index).to_pylist())
                yield part.filter(pa.array([x != UNKNOWN for x in langs], pa.bool_()))
        del predictor
        release()
    return run


def known(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """The documents whose text has a language, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(train(training_texts(docs if labelled is None else labelled)))
    return docs.mapInArrow(_known(model, docs.columns.index("text")), docs.schema)


def identify(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score and phrases_a_letter for every document row, learned from ``labelled``
    (``docs`` unless given)."""
    automata = train(training_texts(docs if labelled is None else labelled))
    model = docs.sparkSession.sparkContext.broadcast(automata)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = rows.mapInArrow(_predict(model), "doc_id long, lang_pred string, score double, phrases_a_letter double")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "phrases_a_letter")
