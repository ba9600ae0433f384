"""External induced suffix sorting with common prefixes, for one shard.

The text is a file of symbols in which 0 ends each string; equal ends count as different, the earlier one
being smaller.  S* suffixes (an S suffix after an L suffix) are sorted by naming the substrings between
them and sorting the sequence of names: in memory if it fits, else by the same induction into slots of one file.  From
their order two sweeps induce all others: upward, every suffix handed out puts its L predecessor into
a priority queue; downward, its S predecessor.  The queue holds tuples (symbol, position, common
prefix with the tuple before of that symbol).  As tuples arrive in their suffixes' order, those of
one symbol stand in a file of their own in order of arrival, and the least symbol in use is handed out next.
The common prefix of two successive tuples is one more than the least one handed out between their
successors, up to ``cap``.  Those of successive S* suffixes, from which these follow, are compared ``PACK``
symbols at a time; so the text's symbols have up to ``BITS`` bits.

Everything of the text's length is on disk; memory holds a chunk of it, the tails of the queues and what
``memory`` allows for naming and for a sequence of names.
"""

from __future__ import annotations

import bisect
import heapq
import os
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np

from ordermart.llm.decontaminate import suffix_order

CHUNK = 1 << 20
MEMORY = 1 << 22  # symbols named or sorted in memory
TAIL = 1 << 16  # tuples of one symbol's queue before they go to its file
BITS = 9  # of a symbol: a byte and the end
PACK = 64 // BITS  # symbols compared at a time
_LEAST = np.uint64(1) << np.arange(0, BITS * PACK, BITS, dtype=np.uint64)  # least differences of the last symbol, the one before it, ...


class Folder:
    """Scratch files of one sort in the task's temporary folder, deleted at its end."""

    def __enter__(self):
        self.path, self.n = tempfile.mkdtemp(prefix="induced-"), 0
        return self

    def __exit__(self, *_):
        shutil.rmtree(self.path, ignore_errors=True)

    def name(self) -> str:
        self.n += 1
        return os.path.join(self.path, str(self.n))

    def array(self, dtype, n: int) -> np.ndarray:
        return np.memmap(self.name(), dtype, "w+", shape=(n,)) if n else np.zeros(0, dtype)

    @staticmethod
    def drop(*arrays: np.ndarray) -> None:
        """Delete the files of arrays that are read no more."""
        for x in arrays:
            if isinstance(x, np.memmap):
                os.unlink(x.filename)


def places_of(n: int):
    """The type that holds places of a text of n symbols."""
    return np.int32 if n < 2**31 else np.int64


class Tuples:
    """Successive (position, common prefix) tuples: a tail in memory, the rest in a file."""

    def __init__(self, folder: Folder, place):
        self.folder, self.file, self.tail, self.on_file, self.size = folder, None, [], 0, 0
        self.kind = np.dtype([("at", place), ("lcp", np.uint16)])

    def add(self, at: np.ndarray, lcp: np.ndarray) -> None:
        rows = np.empty(len(at), self.kind)
        rows["at"], rows["lcp"] = at, lcp
        self.tail.append(rows)
        self.size += len(at)
        if self.size - self.on_file > TAIL:
            self.file = self.file or self.folder.name()
            with open(self.file, "ab") as f:
                f.write(np.concatenate(self.tail).tobytes())
            self.tail, self.on_file = [], self.size

    def read(self, begin: int, end: int) -> np.ndarray:
        parts = []
        if begin < self.on_file:
            parts.append(np.fromfile(self.file, self.kind, min(end, self.on_file) - begin, offset=self.kind.itemsize * begin))
        if end > self.on_file:
            if len(self.tail) > 1:
                self.tail = [np.concatenate(self.tail)]
            parts.append(self.tail[0][max(begin - self.on_file, 0): end - self.on_file])
        return np.concatenate(parts) if len(parts) > 1 else parts[0]

    def drop(self) -> None:
        if self.file:
            os.unlink(self.file)
        self.tail = []

    def upward(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Chunks in order; tuples added meanwhile come too."""
        done = 0
        while done < self.size:
            rows = self.read(done, min(done + CHUNK, self.size))
            done += len(rows)
            yield rows["at"].astype(np.int64), rows["lcp"].astype(np.int64)

    def downward(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Chunks from the end, each tuple with its common prefix with the one handed out before it."""
        end, before = self.size, 0
        while end > 0:
            rows = self.read(max(0, end - CHUNK), end)[::-1]
            end -= len(rows)
            lcp = rows["lcp"].astype(np.int64)
            yield rows["at"].astype(np.int64), np.concatenate([[before], lcp[:-1]])
            before = int(lcp[-1])


class PriorityQueue:
    """Tuples by symbol, least (or greatest) symbol first."""

    def __init__(self, folder: Folder, place, cap: int, descending: bool = False):
        self.folder, self.place, self.cap, self.sign = folder, place, cap, -1 if descending else 1
        self.of: dict[int, Tuples] = {}
        self.heap: list[int] = []
        self.least = np.full(1 << 16, cap, np.int64)  # handed out since a symbol's last tuple

    def next_symbol(self) -> int | None:
        return self.sign * self.heap[0] if self.heap else None

    def pop(self) -> Tuples:
        return self.of[self.sign * heapq.heappop(self.heap)]

    def insert(self, handed: np.ndarray, symbols: np.ndarray, at: np.ndarray, when: np.ndarray, current: int) -> None:
        """Tuples whose successors are the ones numbered ``when`` (ascending) of a batch that was handed out
        with the common prefixes ``handed``; ``current``: the symbol being handed out."""
        order = np.argsort(symbols, kind="stable")
        s, at, when = symbols[order], at[order], when[order]
        heads = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
        rest = []
        for c, a, b in zip(s[heads].tolist(), heads.tolist(), np.append(heads, len(s))[1:].tolist(), strict=True):
            new = c not in self.of
            if new:
                self.of[c] = Tuples(self.folder, self.place)
                if c != current:
                    heapq.heappush(self.heap, self.sign * c)
            own = when[a:b]
            lcp = np.minimum.reduceat(handed[: own[-1] + 1], np.concatenate([[0], own[:-1] + 1]))
            lcp[0] = -1 if new else min(lcp[0], self.least[c])
            lcp = np.minimum(lcp + 1, self.cap)
            tail = handed[own[-1] + 1:]
            rest.append((c, int(tail.min()) if len(tail) else self.cap))
            self.of[c].add(at[a:b], lcp)
        if len(handed):
            np.minimum(self.least, handed.min(), out=self.least)
            for c, low in rest:
                self.least[c] = low


def suffix_types(text: np.ndarray, folder: Folder) -> np.ndarray:
    """Whether each suffix is an S suffix (less than the one after it); ends are."""
    n = len(text)
    out = folder.array(np.bool_, n)
    follow, kind = 0, True  # the last symbol is an end
    for end in range(n, 0, -CHUNK):
        begin = max(0, end - CHUNK)
        x = np.append(np.asarray(text[begin:end]), follow).astype(np.int64)
        differs = x[:-1] != x[1:]
        own = np.append(x[:-1] < x[1:], kind)
        decided = np.where(np.append(differs, True), np.arange(len(x)), len(x))
        first = np.minimum.accumulate(decided[::-1])[::-1][:-1]  # the next place where symbols differ decides
        s = own[first] | (x[:-1] == 0)
        out[begin:end] = s
        follow, kind = int(x[0]), bool(s[0])
    return out


def star_places(text: np.ndarray, types: np.ndarray, folder: Folder) -> np.ndarray:
    name, before = folder.name(), True
    with open(name, "wb") as f:
        for begin in range(0, len(text), CHUNK):
            s = np.asarray(types[begin: begin + CHUNK])
            f.write((begin + np.flatnonzero(s & ~np.concatenate([[before], s[:-1]]))).astype(places_of(len(text))).tobytes())
            before = bool(s[-1])
    return np.memmap(name, places_of(len(text)), "r") if os.path.getsize(name) else np.zeros(0, np.int64)


def star_names(text: np.ndarray, types: np.ndarray, stars: np.ndarray, largest: int, memory: int, folder: Folder) -> np.ndarray:
    """Names of the substrings from each S* place to the next, in their order, and a closing 0.  Ends
    come first; a substring that reaches an end is equal to none."""
    base = 2 * largest + 4
    k = max(1, int(62 // np.log2(base)))

    def word(at: np.ndarray, last: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.int64)
        for j in range(k):
            p = np.minimum(at + j, len(text) - 1)
            out = out * base + np.where(at + j <= last, 2 * text[p].astype(np.int64) + types[p] + 1, 0)
        return out

    n = len(stars)
    last = lambda i: np.asarray(stars[np.minimum(i + 1, n - 1)]).astype(np.int64)
    names, firsts, taken = folder.array(places_of(len(text)), n + 1), folder.array(np.int64, n), 0
    for begin in range(0, n, CHUNK):
        i = np.arange(begin, min(begin + CHUNK, n))
        at = np.asarray(stars[i]).astype(np.int64)
        end = text[at] == 0
        names[i[end]] = taken + 1 + np.arange(end.sum())
        taken += int(end.sum())
        firsts[i] = np.where(end, -1, word(at, last(i)))
    # ranges of first words that fit in memory, from a sample of them
    sample = np.sort(np.asarray(firsts[:: max(1, n // 65536)]))
    splits = np.unique(sample[:: max(1, len(sample) * memory // (2 * max(n, 1)))]) if n > memory else sample[:0]
    for low, high in zip(np.append([0], splits[splits > 0]), np.append(splits[splits > 0], np.iinfo(np.int64).max), strict=True):
        own = np.concatenate([begin + np.flatnonzero((f >= low) & (f < high)) for begin in range(0, n, CHUNK) for f in [np.asarray(firsts[begin: begin + CHUNK])]]) if n else np.zeros(0, np.int64)
        if not len(own):
            continue
        at, stop = np.asarray(stars[own]).astype(np.int64), last(own).astype(np.int64)
        order, group = np.arange(len(own)), np.zeros(len(own), np.int64)
        new = np.zeros(len(own), bool)
        new[0] = True
        slots, key, step = np.arange(len(own)), np.asarray(firsts[own]), 0
        while len(slots):
            by = np.lexsort((key, group[slots])) if step else np.argsort(key, kind="stable")
            order[slots] = order[slots][by]
            key, g = key[by], group[slots][by]
            fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (g[1:] != g[:-1])])
            new[slots] |= fresh
            group = np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))
            step += k
            tied = ~(new & np.append(new[1:], True))
            slots = np.flatnonzero(tied & (at[order] + step <= stop[order]))
            key = word(at[order[slots]] + step, stop[order[slots]])
        ends = text[stop[order]] == 0  # tied ones are in text order, which is the order of their ends
        new |= ends
        names[own[order]] = taken + np.cumsum(new)
        taken += int(new.sum())
    names[n] = 0
    folder.drop(firsts)
    return names


def packed(text: np.ndarray, folder: Folder) -> np.ndarray:
    """For each place the ``PACK`` symbols from there in one number, the first one highest; 0 after the text's end."""
    out = folder.array(np.uint64, len(text))
    for begin in range(0, len(text), CHUNK):
        n = min(CHUNK, len(text) - begin)
        x = np.zeros(n + PACK - 1, np.uint64)
        own = text[begin: begin + len(x)]
        x[: len(own)] = own
        words = x[:n]
        for j in range(1, PACK):
            words = (words << np.uint64(BITS)) | x[j: j + n]
        out[begin: begin + n] = words
    return out


def common_prefix(words: np.ndarray, a: np.ndarray, b: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Common prefixes of pairs of suffixes of a packed text, up to ``room``."""
    out = np.zeros(len(a), np.int64)
    live = np.flatnonzero(room > 0)
    done = 0
    while len(live):
        differ = words[a[live] + done] ^ words[b[live] + done]
        unequal = differ != 0
        out[live[unequal]] = done + PACK - np.searchsorted(_LEAST, differ[unequal], "right")
        live = live[~unequal]
        done += PACK
        out[live] = done
        live = live[room[live] > done]
    return np.minimum(out, room)


def star_prefixes(text: np.ndarray, ends: np.ndarray, stars: np.ndarray, cap: int, folder: Folder) -> np.ndarray:
    """Common prefixes of successive S* suffixes, within their strings, up to cap; 0 for the first."""
    out, words = folder.array(np.uint16, len(stars)), packed(text, folder)
    before, room = 0, 0
    for begin in range(0, len(stars), CHUNK):
        b = np.asarray(stars[begin: begin + CHUNK]).astype(np.int64)
        left = np.minimum(ends[np.searchsorted(ends, b)] - b, cap)
        out[begin: begin + CHUNK] = common_prefix(words, np.append(before, b[:-1]), b, np.minimum(np.append(room, left[:-1]), left))
        before, room = b[-1], left[-1]
    folder.drop(words)
    return out


def predecessors(text: np.ndarray, types: np.ndarray, folder: Folder) -> np.ndarray:
    """For each place twice the symbol before it, and 1 more if an S suffix begins there; 0 at the text's begin."""
    out = folder.array(np.uint16 if text.dtype == np.uint16 else np.int64, len(text))
    for begin in range(1, len(text), CHUNK):
        own = slice(begin - 1, min(begin + CHUNK, len(text)) - 1)
        out[begin: begin + CHUNK] = text[own].astype(out.dtype) * 2 + types[own]
    return out


def induce(text, types, stars: np.ndarray, star_lcp, cap: int, folder: Folder) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes that begin with no end, greatest first, in chunks of (position, common prefix with the one
    before), from the S* places in order."""
    place = places_of(len(text))
    up = PriorityQueue(folder, place, cap)

    scratch = predecessors(text, types, folder)
    left, text, stars = np.asarray(scratch), np.asarray(text), np.asarray(stars)  # a memmap's own indexing is slow for single places

    def hand_out(queue, at, lcp, c, want):
        own = left[at]
        when = np.flatnonzero((own > 1) & ((own & 1) == want))
        queue.insert(lcp, own[when] >> 1, at[when] - 1, when, c)

    def meeting(a, b):
        x, y = text[a: a + cap], text[b: b + cap]
        n = min(len(x), len(y))
        stops = np.flatnonzero((x[:n] != y[:n]) | (x[:n] == 0))
        return int(stops[0]) if len(stops) else n

    done, n = 0, len(stars)
    while done < n or up.heap:
        c = up.next_symbol()
        star = int(text[stars[done]]) if done < n else None
        last = None
        if star is None or c is not None and c <= star:
            for at, lcp in up.pop().upward():
                last = int(at[-1])
                hand_out(up, at, lcp, c, False)
        else:
            c = star
        while done < n and text[stars[done]] == c:
            end = bisect.bisect_right(range(done, min(done + CHUNK, n)), c, key=lambda i: text[stars[i]])
            at = stars[done: done + end].astype(np.int64)
            lcp = np.array(star_lcp[done: done + len(at)]).astype(np.int64)
            if last is not None:
                lcp[0] = meeting(last, int(at[0]))
                last = None
            elif text[stars[max(done - 1, 0)]] != c:
                lcp[0] = 0
            hand_out(up, at, lcp, c, False)
            done += len(at)
    down = PriorityQueue(folder, place, cap, descending=True)
    upper = sorted(up.of)
    while upper or down.heap:
        c = down.next_symbol()
        last = None
        if c is not None and (not upper or c >= upper[-1]):
            own = down.pop()
            for at, lcp in own.upward():
                last = int(at[-1])
                hand_out(down, at, lcp, c, True)
                yield at, lcp
            own.drop()
        else:
            c = upper[-1]
        if upper and upper[-1] == c:
            own = up.of[upper.pop()]
            for at, lcp in own.downward():
                if last is not None:
                    lcp[0] = meeting(last, int(at[0]))
                    last = None
                hand_out(down, at, lcp, c, True)
                yield at, lcp
            own.drop()
    folder.drop(scratch)


def sort_stars(text, types, largest: int, memory: int, folder: Folder) -> np.ndarray:
    """The S* places in the order of their suffixes."""
    stars = star_places(text, types, folder)
    names = star_names(text, types, stars, largest, memory, folder)
    if len(names) <= memory:
        order = suffix_order(np.asarray(names).astype(np.int64), 1)[1:]
    else:
        order = sort_suffixes(names, int(names.max()), memory, folder)
    out = folder.array(places_of(len(text)), len(order))
    for begin in range(0, len(order), CHUNK):
        out[begin: begin + CHUNK] = stars[order[begin: begin + CHUNK]]
    folder.drop(names, stars, order)
    return out


def bucket_starts(text: np.ndarray, largest: int, folder: Folder) -> np.ndarray:
    """Where each symbol's suffixes begin in the order of all, and the length of the text."""
    out = folder.array(np.int64, largest + 2)
    for begin in range(0, len(text), CHUNK):
        values, counts = np.unique(text[begin: begin + CHUNK], return_counts=True)
        out[values.astype(np.int64) + 1] += counts
    np.cumsum(out, out=out)
    return out


def sort_suffixes(text: np.ndarray, largest: int, memory: int, folder: Folder) -> np.ndarray:
    """Suffix order of a text with one end, its last symbol, without that.  With about as many symbols as places a queue
    for each would be mostly queues; here the symbols' queues are consecutive slots of one file, and the slots handed
    out together are as many as none of them induces."""
    types, n = suffix_types(text, folder), len(text)
    stars, left = sort_stars(text, types, largest, memory, folder), predecessors(text, types, folder)
    starts = bucket_starts(text, largest, folder)
    heads, tails = folder.array(np.int64, largest + 1), folder.array(np.int64, largest + 1)
    heads[:], tails[:] = starts[:-1], starts[1:]
    out = folder.array(places_of(n), n)
    for begin in range(0, n, CHUNK):
        out[begin: begin + CHUNK] = -1
    for end in range(len(stars), 0, -CHUNK):  # S* suffixes are the last ones of their symbols for now
        at = np.asarray(stars[max(0, end - CHUNK): end])[::-1]
        insert_slots(text[at], tails, out, at, -1)
    tails[:] = starts[1:]
    for ends, step, want in ((heads, 1, 0), (tails, -1, 1)):
        done, size = 0, 1 << 10
        while done < n:
            slots = np.arange(done, min(done + size, n)) if step > 0 else np.arange(n - 1 - done, max(n - 1 - done - size, -1), -1)
            at = out[slots].astype(np.int64)
            own = left[np.maximum(at, 0)]
            when = np.flatnonzero((at >= 0) & (own > 1) & ((own & 1) == want))
            ready = insert_slots(own[when] >> 1, ends, out, at[when] - 1, step, slots, when)
            done, size = done + ready, min(CHUNK, max(1 << 10, 2 * ready))
    folder.drop(types, stars, left, starts, heads, tails)
    return out[1:]


def insert_slots(symbols, ends, out, at, step: int, slots=None, when=None) -> int:
    """Put places into the next slots of their symbols, up (1) or down (-1).  If they come from the places at ``when`` of
    ``slots``, only those before the first slot that one of them fills; returns how many slots that are."""
    ready = len(slots) if slots is not None else len(at)
    if len(at):
        symbols = symbols.astype(np.int64)
        order = np.argsort(symbols, kind="stable")
        s = symbols[order]
        head = np.concatenate([[True], s[1:] != s[:-1]])
        i = np.arange(len(s))
        to = np.empty(len(s), np.int64)
        to[order] = np.asarray(ends[s]) + (0 if step > 0 else -1) + step * (i - np.maximum.accumulate(np.where(head, i, 0)))
        n = len(at)
        if slots is not None:
            first = np.minimum.accumulate(step * (to - slots[0]))  # of the slots filled so far, counted from the first one handed out
            late = np.flatnonzero(when[1:] >= first[:-1])
            n = int(late[0]) + 1 if len(late) else n
            ready = min(ready, int(first[n - 1]))
        out[to[:n]] = at[:n]
        ends[symbols[:n]] = to[:n] + (1 if step > 0 else 0)  # of equal symbols the last one counts
    return ready


def sorted_suffixes(text: np.ndarray, cap: int, folder: Folder, memory: int = MEMORY) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffixes of a file of strings, greatest first: chunks of (position, common prefix with the one before)."""
    if not len(text):
        return
    types = suffix_types(text, folder)
    name = folder.name()
    with open(name, "wb") as f:
        for begin in range(0, len(text), CHUNK):
            f.write((begin + np.flatnonzero(np.asarray(text[begin: begin + CHUNK]) == 0)).astype(np.int64).tobytes())
    ends = np.memmap(name, np.int64, "r")
    stars = sort_stars(text, types, 256, memory, folder)
    yield from induce(text, types, stars, star_prefixes(text, ends, stars, cap, folder), cap, folder)
