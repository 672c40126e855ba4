"""Grammar compression of id sequences: pairs become rules, round by round.

A rule stands for two symbols, each an id or an earlier rule. In every round
the most frequent neighbours of a shard get rules, and their occurrences are
replaced from the left, until no pair stands ``LEAST_COUNT`` times. After a
count of all pairs the rounds that follow look only at the places where the
round before has made a symbol, since no other pair can have become frequent;
symbols are linked there, so such a round costs what it changes. When no place
is left all pairs are counted again. No rule crosses the end of a document, so
a document is a range of symbols, and the expansion lengths of the rules give
the place of any id without decoding what comes before it.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

MAGIC = b"TWRP0001"
#: Rules given out before the symbols are counted again.
RULES_PER_ROUND = 8192
#: A pair gets a rule if it stands so often; a rule takes sixteen bytes, a symbol two.
LEAST_COUNT = 24
_BUCKET_BITS = 18


@dataclass
class Grammar:
    """``terminals`` plain ids, then rules; ``symbols`` of all documents; ``ends`` per document."""

    terminals: int
    rules: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray
    ends: np.ndarray


def _buckets(symbols: np.ndarray) -> np.ndarray:
    """A bucket for each pair of neighbours."""
    mixed = symbols[:-1] * np.uint32(0x9E3779B1) + symbols[1:] * np.uint32(0x85EBCA77)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    return mixed >> np.uint32(32 - _BUCKET_BITS)


def _key(symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
    return symbols[at].astype(np.uint64) << np.uint64(32) | symbols[at + 1]


def _frequent_pairs(symbols: np.ndarray, last: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The up to ``most`` most frequent pairs by falling count, and their places.

    Buckets bound the counts from above. In each bucket that may be among the
    first, one pair is counted exactly; another one that shares it waits for a
    later round. Returns the keys, the places of their occurrences and the rank
    of each occurrence.
    """
    bucket = _buckets(symbols)
    # what is no pair goes into a bucket of its own
    none = 1 << _BUCKET_BITS
    bucket[last[:-1]] = none
    counts = np.bincount(bucket, minlength=none + 1)
    counts[none] = 0
    least = LEAST_COUNT if most > none else max(LEAST_COUNT, int(np.partition(counts, -most)[-most]))
    at = np.flatnonzero((counts >= least)[bucket])
    of = bucket[at]
    found = _key(symbols, at)
    holder = np.zeros(1 << _BUCKET_BITS, np.uint64)
    holder[of[::-1]] = found[::-1]
    held = holder[of] == found
    at, of = at[held], of[held]
    exact = np.bincount(of, minlength=1 << _BUCKET_BITS)
    first = np.flatnonzero(exact >= LEAST_COUNT)
    if not len(first):
        at = np.flatnonzero((counts >= LEAST_COUNT)[bucket])
        return _counted_pairs(_key(symbols, at), at, most)
    first = first[np.lexsort((holder[first], -exact[first]))[:most]]
    rank_of = np.full(1 << _BUCKET_BITS, -1, np.int32)
    rank_of[first] = np.arange(len(first), dtype=np.int32)
    rank = rank_of[of]
    keep = rank >= 0
    return holder[first], at[keep], rank[keep]


def _counted_pairs(keys: np.ndarray, at: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same by counting the pairs with the given keys and places."""
    # a rough count by hash spares the sort of pairs that are surely rare
    rough = ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)
    some = (np.bincount(rough, minlength=1 << _BUCKET_BITS) >= LEAST_COUNT)[rough]
    keys, at = keys[some], at[some]
    known, of, counts = np.unique(keys, return_inverse=True, return_counts=True)
    first = np.flatnonzero(counts >= LEAST_COUNT)
    first = first[np.lexsort((known[first], -counts[first]))[:most]]
    rank_of = np.full(len(known), -1, np.int32)
    rank_of[first] = np.arange(len(first), dtype=np.int32)
    rank = rank_of[of]
    return known[first], at[rank >= 0], rank[rank >= 0]


def _apart(after: np.ndarray, hit: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The occurrences to replace; where two overlap, the more frequent pair wins, then the left one."""
    taken = []
    while len(hit):
        n = np.arange(len(hit))
        left = np.r_[False, after[hit[:-1]] == hit[1:]]
        lower = np.r_[False, rank[:-1] < rank[1:]] & left
        equal = np.r_[False, rank[:-1] == rank[1:]] & left
        higher = np.r_[(rank[1:] < rank[:-1]) & left[1:], False]
        # of a run of equal ranks every second place, unless a better one stands before the run
        begin = np.maximum.accumulate(np.where(equal, 0, n))
        best = ~higher & ((n - begin) % 2 == 0) & ~lower[begin]
        taken.append((hit[best], rank[best]))
        gone = best | np.r_[best[1:] & left[1:], False] | np.r_[False, best[:-1]] & left
        hit, rank = hit[~gone], rank[~gone]
    return np.concatenate([h for h, _ in taken]), np.concatenate([r for _, r in taken])


def _replaced(
    symbols: np.ndarray, last: np.ndarray, keys: np.ndarray, hit: np.ndarray, rank: np.ndarray, first_rule: int
) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Symbols and ends after replacing the pairs and all that become frequent by it, and the pairs of the new rules."""
    n = len(symbols)
    symbols, last = symbols.copy(), last.copy()
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    alive = np.ones(n, bool)
    rules = []
    while len(keys):
        place, which = _apart(after, hit, rank)
        gone = after[place]
        follows = after[gone]
        symbols[place] = first_rule + which
        last[place] = last[gone]
        alive[gone] = False
        after[place] = follows
        inside = follows < n
        before[follows[inside]] = place[inside]
        rules.append(keys)
        first_rule += len(keys)
        at = np.sort(np.concatenate([place, before[place]]))
        at = at[np.r_[True, at[1:] != at[:-1]] & (at >= 0)]
        at = at[~last[at]]
        keys, hit, rank = _counted_pairs(symbols[at].astype(np.uint64) << np.uint64(32) | symbols[after[at]], at, RULES_PER_ROUND)
    return symbols[alive], last[alive], rules


def compress(documents: list[np.ndarray], terminals: int) -> Grammar:
    """A grammar for the ids of some documents, all of them below ``terminals``."""
    sizes = np.array([len(d) for d in documents], np.int64)
    symbols = np.concatenate([*documents, np.empty(0, np.uint32)]).astype(np.uint32)
    last = np.zeros(len(symbols), bool)
    last[np.cumsum(sizes)[sizes > 0] - 1] = True
    empty = sizes == 0
    rules = np.empty((0, 2), np.uint32)
    while len(symbols) > 1:
        keys, places, ranks = _frequent_pairs(symbols, last, RULES_PER_ROUND)
        if not len(keys):
            break
        symbols, last, made = _replaced(symbols, last, keys, places, ranks, terminals + len(rules))
        pairs = np.concatenate(made)
        rules = np.r_[rules, np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32)]
    lengths: list[int] = []
    for a, b in rules.tolist():
        lengths.append((lengths[a - terminals] if a >= terminals else 1) + (lengths[b - terminals] if b >= terminals else 1))
    ends = np.zeros(len(sizes), np.int64)
    ends[~empty] = np.flatnonzero(last) + 1
    return Grammar(terminals, rules, np.array(lengths, np.int64), symbols, np.maximum.accumulate(ends) if len(ends) else ends)


def to_bytes(g: Grammar) -> bytes:
    """Header, rules, expansion lengths, document ends, symbols; all little-endian.

    The header states the width of a symbol: two bytes where they suffice.
    """
    width = 2 if g.terminals + len(g.rules) <= 1 << 16 else 4
    head = struct.pack("<8sIIIQQ", MAGIC, width, g.terminals, len(g.rules), len(g.ends), len(g.symbols))
    parts = [g.rules.astype("<u4"), g.lengths.astype("<u8"), g.ends.astype("<u8"), g.symbols.astype(f"<u{width}")]
    return head + b"".join(p.tobytes() for p in parts)


_HEAD = struct.calcsize("<8sIIIQQ")


def from_bytes(data: bytes) -> Grammar:
    magic, width, terminals, n_rules, n_docs, n_symbols = struct.unpack_from("<8sIIIQQ", data)
    if magic != MAGIC:
        raise ValueError("not a shard of this format")
    at = _HEAD
    out = []
    for count, kind, size in ((n_rules * 2, "<u4", 4), (n_rules, "<u8", 8), (n_docs, "<u8", 8), (n_symbols, f"<u{width}", width)):
        out.append(np.frombuffer(data, kind, count, at))
        at += count * size
    rules, lengths, ends, symbols = out
    return Grammar(terminals, rules.reshape(-1, 2), lengths.astype(np.int64), symbols, ends.astype(np.int64))


class Reader:
    """Random access to the documents of a shard."""

    def __init__(self, g: Grammar):
        self.g = g
        whole: list[bytes] = []
        n, pack = g.terminals, struct.Struct("<I").pack
        for a, b in g.rules.tolist():
            whole.append((whole[a - n] if a >= n else pack(a)) + (whole[b - n] if b >= n else pack(b)))
        self.texts = np.frombuffer(b"".join(whole), "<u4")
        self.starts = np.r_[0, np.cumsum(g.lengths)].astype(np.int64)

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that a run of symbols stands for."""
        symbols = symbols.astype(np.int64)
        rule = symbols - self.g.terminals
        is_rule = rule >= 0
        sizes = np.ones(len(symbols), np.int64)
        sizes[is_rule] = self.g.lengths[rule[is_rule]]
        begin = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), np.uint32)
        out[begin[~is_rule]] = symbols[~is_rule]
        n = sizes[is_rule]
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(begin[is_rule], n) + inside] = self.texts[np.repeat(self.starts[rule[is_rule]], n) + inside]
        return out

    def symbols_of(self, i: int) -> np.ndarray:
        return self.g.symbols[(self.g.ends[i - 1] if i else 0) : self.g.ends[i]]

    def document(self, i: int) -> np.ndarray:
        return self.expand(self.symbols_of(i))

    def documents(self) -> list[np.ndarray]:
        """All documents in order."""
        return np.split(self.expand(self.g.symbols), np.cumsum(self.sizes())[:-1]) if len(self.g.ends) else []

    def sizes(self) -> np.ndarray:
        """Ids of each document, from the expansion lengths alone."""
        each = np.ones(len(self.g.symbols), np.int64)
        rule = self.g.symbols.astype(np.int64) - self.g.terminals
        each[rule >= 0] = self.g.lengths[rule[rule >= 0]]
        total = np.r_[0, np.cumsum(each)]
        return np.diff(np.r_[0, total[self.g.ends]])
