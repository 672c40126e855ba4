"""Suffix order of a shard by induced sorting, with common prefixes carried along.

Suffixes that are smaller than their right neighbour but whose left neighbour
is larger (S*) are put in order by doubling the ranks of their names; all others
are induced from them. Induction is a queue ordered by first character
and rank: in the scan upwards each suffix hands its left neighbour to the queue
of that neighbour's character, and since the scan is in order, each queue is
filled in order. Queues keep a bounded number of entries in memory and the rest
in a file; all that a queue holds is scanned at once. An entry holds the place of the suffix and the length of the prefix
that it shares with the entry before, which is one more than the least shared
length among the suffixes scanned between the two.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

#: Shared prefixes are counted up to this length.
FULL = np.int32(2**30)
QUEUE_ENTRIES = 4_000_000
#: Entries of a text (bytes and two marks) that are compared at once, and their bits.
LANES, BITS = 7, 9


class Queues:
    """First-in-first-out queues by character, in memory up to a bound and then in one file."""

    def __init__(self, entries: int = QUEUE_ENTRIES):
        self.most, self.held = entries, 0
        self.parts: dict[int, list] = {}
        self.file = None

    def add(self, char: int, place: np.ndarray, shared: np.ndarray) -> None:
        self.parts.setdefault(char, []).append((place, shared))
        self.held += len(place)
        if self.held > self.most:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        for parts in self.parts.values():
            for k, part in enumerate(parts):
                if not isinstance(part[0], int):
                    at = self.file.seek(0, 2)
                    self.file.write(part[0].tobytes() + part[1].tobytes())
                    parts[k] = (at, len(part[0]))
        self.held = 0

    def take(self, char: int) -> tuple[np.ndarray, np.ndarray] | None:
        """All entries of a character so far, in order of arrival; the queue is empty then."""
        out = []
        for part in self.parts.pop(char, []):
            if isinstance(part[0], int):
                at, n = part
                self.file.seek(at)
                place = np.frombuffer(self.file.read(8 * n), np.int64)
                part = (place, np.frombuffer(self.file.read(4 * n), np.int32))
            else:
                self.held -= len(part[0])
            out.append(part)
        if len(out) < 2:
            return out[0] if out else None
        return np.concatenate([p for p, _ in out]), np.concatenate([s for _, s in out])

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class _Emitter:
    """Hands the left neighbours of a scanned batch to their queues."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, queues: Queues, chars: int, carry: bool):
        self.text, self.wanted, self.queues, self.carry = text, wanted, queues, carry
        self.since = np.full(chars, FULL, np.int32)
        self.filled = np.zeros(chars, bool)

    def batch(self, place: np.ndarray, shared: np.ndarray) -> None:
        left = place - 1
        use = np.flatnonzero(left >= 0)
        use = use[self.wanted[left[use]]]
        least = shared.min() if self.carry and len(shared) else FULL
        if not len(use):
            np.minimum(self.since, least, out=self.since)
            return
        target = self.text[left[use]]
        order = np.argsort(target.astype(np.uint16), kind="stable")
        target, use = target[order], use[order]
        begin = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
        ends = np.r_[begin[1:], len(target)]
        since = np.minimum(self.since, least)
        for b, e in zip(begin.tolist(), ends.tolist(), strict=True):
            c, some = int(target[b]), use[b:e]
            if self.carry:
                # least shared length from one source (exclusive) to the next (inclusive)
                cuts = np.r_[0, some + 1]
                tail = cuts[-1] == len(shared)
                lows = np.minimum.reduceat(shared, cuts[:-1] if tail else cuts)
                between = lows[: len(some)].copy()
                between[0] = min(between[0], self.since[c])
                new = between + 1
                if not self.filled[c]:
                    new[0] = 0
                since[c] = FULL if tail else lows[-1]
            else:
                new = np.zeros(len(some), np.int32)
            self.filled[c] = True
            self.queues.add(c, left[some], new.astype(np.int32))
        self.since = since


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Shared prefix lengths of pairs of different suffixes, up to ``cap``, by direct comparison.

    Entries are below 2**9; the one zero at the end stops every comparison, so
    no pair that is still equal reaches beyond it.
    """
    out = np.full(len(a), cap, np.int32)
    live = np.arange(len(a))
    x, y = a.astype(np.int64), b.astype(np.int64)
    words = _words(text) if len(a) > 1000 else None
    for k in range(0, cap, LANES):
        if words is not None:
            differ = words[x] ^ words[y]
        else:
            differ = _words_at(text, x) ^ _words_at(text, y)
        apart = np.flatnonzero(differ)
        if len(apart):
            d = differ[apart]
            lowest = d & (~d + np.uint64(1))
            lane = (np.bitwise_count(lowest - np.uint64(1)) // BITS).astype(np.int32)
            out[live[apart]] = np.minimum(k + lane, cap)
            keep = np.flatnonzero(differ == 0)
            live, x, y = live[keep], x[keep], y[keep]
        if not len(live):
            break
        x += LANES
        y += LANES
    return out


def _words(text: np.ndarray) -> np.ndarray:
    """Seven entries from each place on in one number; the end of the text differs from all else."""
    n = len(text)
    t = np.r_[text.astype(np.uint64), np.zeros(LANES, np.uint64)]
    out = t[:n].copy()
    for k in range(1, LANES):
        out |= t[k : n + k] << np.uint64(BITS * k)
    return out


def _words_at(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at), np.uint64)
    for k in range(LANES):
        inside = at + k < len(text)
        out |= np.where(inside, text[np.minimum(at + k, len(text) - 1)], 0).astype(np.uint64) << np.uint64(BITS * k)
    return out


def _types(text: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than the one on their right (S); the last is S."""
    n = len(text)
    step = np.r_[np.sign(text[1:].astype(np.int64) - text[:-1]), 1]
    at = np.where(step != 0, np.arange(n), n)
    return step[np.minimum.accumulate(at[::-1])[::-1]] > 0


def induce(
    text: np.ndarray, small: np.ndarray, stars: np.ndarray, shared: np.ndarray, cap: int, carry: bool, entries: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes from the greatest to the least, given the S* suffixes in order.

    Yields places and, for each, the length shared with the suffix yielded just
    before. Without ``carry`` the lengths are meaningless.
    """
    chars = int(text.max()) + 1
    star_begin = np.searchsorted(text[stars], np.arange(chars + 1))
    up = Queues(entries)
    emit = _Emitter(text, ~small, up, chars, carry)
    large = Queues(entries)

    def meet(a: int, b: int) -> int:
        return int(_common(text, np.array([a]), np.array([b]), cap)[0]) if carry else 0

    used = np.flatnonzero(np.bincount(text, minlength=chars))
    for c in used.tolist():
        last = -1
        while (some := up.take(c)) is not None:
            place, both = some[0], np.minimum(some[1], cap)
            emit.batch(place, both)
            large.add(c, place, both)
            last = int(place[-1])
        some = stars[star_begin[c] : star_begin[c + 1]]
        if len(some):
            both = shared[star_begin[c] : star_begin[c + 1]].copy()
            both[0] = meet(last, int(some[0])) if last >= 0 else 0
            emit.batch(some, both)
    up.close()

    down = Queues(entries)
    emit = _Emitter(text, small, down, chars, carry)
    for c in used[::-1].tolist():
        last = -1
        while (some := down.take(c)) is not None:
            place, both = some[0], np.minimum(some[1], cap)
            emit.batch(place, both)
            yield place, both
            last = int(place[-1])
        some = large.take(c)
        if some is not None:
            place, up_shared = some[0][::-1], some[1]
            both = np.r_[np.int32(meet(last, int(place[0])) if last >= 0 else 0), up_shared[:0:-1]].astype(np.int32)
            emit.batch(place, both)
            yield place, both
        if c == 0:
            yield np.array([len(text) - 1]), np.zeros(1, np.int32)
    large.close()
    down.close()


def _order_of_names(names: np.ndarray) -> np.ndarray:
    """Suffix order of a string of names that ends in its only zero, by doubling.

    The rank of a suffix is the place of the first one that equals it so far;
    only suffixes that share a rank are sorted again, by the rank as many names
    further on as are known to be equal.
    """
    n = len(names)
    out = np.empty(n, np.int64)
    rank = np.zeros(n, np.int64)
    # the whole string is one group that is parted by its names
    live, old, second, known = np.arange(n), np.zeros(n, np.int64), names, 0
    while len(live):
        key = old * (n + 1) + second
        order = np.argsort(key, kind="stable")
        live, key, old = live[order], key[order], old[order]
        at = np.arange(len(live))
        starts = np.empty(len(live), bool)
        starts[0] = True
        np.not_equal(old[1:], old[:-1], out=starts[1:])
        slot = old + at - np.maximum.accumulate(np.where(starts, at, 0))
        np.not_equal(key[1:], key[:-1], out=starts[1:])
        new = slot[np.maximum.accumulate(np.where(starts, at, 0))]
        rank[live] = new
        alone = starts.copy()
        alone[:-1] &= starts[1:]
        out[slot[alone]] = live[alone]
        live, old = live[~alone], new[~alone]
        known = max(1, 2 * known)
        second = rank[live + known]
    return out


def descending_suffixes(
    text: np.ndarray, cap: int, entries: int = QUEUE_ENTRIES
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes of ``text``, greatest first, each with the prefix shared with the one before, up to ``cap``.

    ``text`` holds small numbers and ends in its only zero.
    """
    small = _types(text)
    stars = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if not len(stars):
        stars = np.array([len(text) - 1])
    none = np.zeros(len(stars), np.int32)
    # sort the S* substrings by inducing from S* suffixes in order of their first character only
    rough = stars[np.argsort(text[stars], kind="stable")]
    is_star = np.zeros(len(text), bool)
    is_star[stars] = True
    ordered = np.concatenate([p[is_star[p]] for p, _ in induce(text, small, rough, none, cap, False, entries)])[::-1]
    number = np.empty(len(text), np.int64)
    number[stars] = np.arange(len(stars))
    lengths = np.diff(np.r_[stars, len(text) - 1]) + 1
    a, b = ordered[:-1], ordered[1:]
    size = lengths[number[b]]
    same = lengths[number[a]] == size
    pairs = np.flatnonzero(same)
    if len(pairs):
        live, k = pairs, 0
        while len(live):
            live = live[k < size[live]]
            equal = text[a[live] + k] == text[b[live] + k]
            same[live[~equal]] = False
            live = live[equal]
            k += 1
    names = np.empty(len(stars), np.int64)
    names[number[ordered]] = np.r_[0, np.cumsum(~same)]
    if len(stars) > 1:
        ordered = stars[_order_of_names(names)]
    shared = np.r_[np.int32(0), _common(text, ordered[:-1], ordered[1:], cap)].astype(np.int32)
    yield from induce(text, small, ordered, shared, cap, True, entries)


def repeated_places(segments: list[bytes], length: int, entries: int = QUEUE_ENTRIES) -> list[np.ndarray]:
    """For each segment the places at which a string of ``length`` bytes starts that also starts elsewhere in the segments."""
    sizes = np.array([len(s) for s in segments], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    # bytes from 2 on, one 1 behind each segment, a single 0 at the end
    text = np.frombuffer(b"\0".join([*segments, b""]), np.uint8).astype(np.uint16) + 2
    text[starts + sizes] = 1
    text = np.r_[text, np.uint16(0)]
    repeats = np.zeros(len(text), bool)
    before = -1
    for place, shared in descending_suffixes(text, length, entries):
        long = shared >= length
        repeats[place[long]] = True
        repeats[np.r_[before, place[:-1]][long]] = True
        before = int(place[-1])
    out = []
    for s, n in zip(starts.tolist(), sizes.tolist(), strict=True):
        out.append(np.flatnonzero(repeats[s : s + max(0, n - length + 1)]))
    return out
