"""Words of byte-level vocabularies, cut for many texts at once.

The words of ``WORDS`` are cut by comparing the classes of neighbouring
characters over the bytes of a whole slice of texts. Words of up to
``WIDE`` bytes are looked up in a table of slots by their bytes themselves;
only a word whose slot holds another one is encoded. Characters whose class is
not the same in Unicode 3.2 and in Python's version have none here: what is
cut differently by a library with another version is left to the library.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache

import numpy as np

#: How byte-level vocabularies cut a text into words (fixed value).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

LETTER, NUMBER, OTHER, WHITE, UNKNOWN = range(5)
_WHITE = {*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}

#: Bytes of a word that the table can hold, and slots and ids of the table.
WIDE = 16
SLOT_BITS = 20
POOL_IDS = 1 << 22


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every character up to U+FFFF; those beyond are unknown."""

    def of(category: str) -> int:
        return {"L": LETTER, "N": NUMBER}.get(category[0], UNKNOWN if category in ("Cn", "Cs") else OTHER)

    out = np.full(1 << 16, UNKNOWN, np.uint8)
    for i in range(1 << 16):
        c = chr(i)
        new, old = of(unicodedata.category(c)), of(unicodedata.ucd_3_2_0.category(c))
        white = i in _WHITE
        if white or (new == old and unicodedata.category(c) not in ("Zs", "Zl", "Zp") and unicodedata.ucd_3_2_0.category(c) != "Zs"):
            out[i] = WHITE if white else new
    return out


def _characters(x: np.ndarray) -> tuple[np.ndarray | None, np.ndarray]:
    """The first byte of each character (nothing where bytes are characters) and the classes."""
    table = classes()
    if x.max(initial=0) < 0x80:
        return None, table[x]
    first = np.flatnonzero((x & 0xC0) != 0x80)
    lead = x[first]
    kind = table[np.minimum(lead, 0x7F)]
    two = np.flatnonzero((lead >= 0xC0) & (lead < 0xE0))
    at = first[two]
    kind[two] = table[(x[at] & 0x1F).astype(np.int32) << 6 | x[at + 1] & 0x3F]
    three = np.flatnonzero((lead >= 0xE0) & (lead < 0xF0))
    at = first[three]
    kind[three] = table[(x[at] & 0x0F).astype(np.int32) << 12 | (x[at + 1] & 0x3F).astype(np.int32) << 6 | x[at + 2] & 0x3F]
    kind[lead >= 0xF0] = UNKNOWN
    return first, kind


def word_starts(x: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of some texts start, and the places of characters of unknown class.

    ``x`` holds the UTF-8 bytes of the texts one after the other; ``texts`` are
    the starts of those that are not empty, the first of them zero.
    """
    first, kind = _characters(x)
    n = len(kind)
    begins = np.zeros(n + 4, bool)
    begins[texts if first is None else np.searchsorted(first, texts)] = True
    begins[n:] = True
    edge = begins.copy()
    begins[1:n] |= kind[1:] != kind[:-1]
    # of white space before a word the last character stands alone, or with the word if it is a blank
    white = kind == WHITE
    before = np.flatnonzero(white[:-1] & ~white[1:] & ~edge[1:n])
    begins[before] = True
    bytes_of = x if first is None else x[first]
    begins[before[bytes_of[before] == 0x20] + 1] = False
    # an apostrophe that starts a word takes some endings along, which part the letters behind it
    mark = np.flatnonzero(bytes_of == 0x27)
    mark = mark[begins[mark] & ~edge[mark + 1]]
    if len(mark):
        after = np.r_[bytes_of, np.zeros(3, np.uint8)]
        a, b = after[mark + 1], after[mark + 2]
        one = np.isin(a, np.frombuffer(b"stmd", np.uint8))
        two = ((b == ord("e")) & ((a == ord("r")) | (a == ord("v"))) | (a == ord("l")) & (b == ord("l"))) & ~edge[mark + 2]
        begins[mark[one | two] + 1] = False
        begins[mark[one] + 2] = True
        begins[mark[two] + 3] = True
    starts = np.flatnonzero(begins[:n])
    unknown = np.flatnonzero(kind == UNKNOWN)
    return (starts, unknown) if first is None else (first[starts], first[unknown])


_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class WordTable:
    """The ids of words, kept in a fixed number of slots."""

    def __init__(self, encode: Callable[[bytes], list[int]]):
        self.encode = encode
        #: Different words that the last call had to encode.
        self.new = 0
        self._clear()

    def _clear(self) -> None:
        # two numbers of the word's bytes, and one of its width, its count of ids and their place
        self.rows = np.zeros((1 << SLOT_BITS, 3), np.uint64)
        self.pool, self.used = np.zeros(POOL_IDS, np.uint32), 0

    def ids(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words of ``data``, and how many each word has."""
        if self.used > POOL_IDS // 2:
            self._clear()
        wide = ends - starts
        # eight bytes from each place on
        eight = np.ndarray(len(data) + WIDE, "<u8", data + bytes(WIDE + 8), strides=(1,))
        low = eight[starts] & _MASKS[np.minimum(wide, 8)]
        high = np.zeros(len(low), np.uint64)
        long = np.flatnonzero(wide > 8)
        high[long] = eight[starts[long] + 8] & _MASKS[np.minimum(wide[long] - 8, 8)]
        mixed = (low ^ high * np.uint64(0x9E3779B97F4A7C15) ^ wide.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        slot = (mixed * np.uint64(0x94D049BB133111EB) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        rows = self.rows.take(slot, axis=0)
        held = (rows[:, 0] == low) & (rows[:, 1] == high) & ((rows[:, 2] >> np.uint64(56)).astype(np.int64) == wide)
        at = (rows[:, 2] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        count = (rows[:, 2] >> np.uint64(32) & np.uint64(0xFFFF)).astype(np.int64)
        new = np.flatnonzero(~held)
        self.new = 0
        if not len(new):
            return self._gathered(self.pool, at, count)
        known: dict[bytes, tuple[int, int]] = {}
        made: list[int] = []
        places = []
        for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True):
            word = data[a:b]
            place = known.get(word)
            if place is None:
                ids = self.encode(word)
                known[word] = place = len(made), len(ids)
                made += ids
            places.append(place)
        self.new = len(known)
        placed = np.array(places, np.int64)
        at[new], count[new] = placed[:, 0] + self.used, placed[:, 1]
        more = np.array(made, np.uint32)
        if self.used + len(more) > POOL_IDS:  # not kept
            return self._gathered(np.r_[self.pool[: self.used], more], at, count)
        self.pool[self.used : self.used + len(more)] = more
        self.used += len(more)
        keep = new[wide[new] <= WIDE]
        # of the words that share a slot one stays
        keep = keep[np.unique(slot[keep], return_index=True)[1]]
        meta = wide[keep] << 56 | count[keep] << 32 | at[keep]
        self.rows[slot[keep]] = np.stack([low[keep], high[keep], meta.astype(np.uint64)], axis=1)
        return self._gathered(self.pool, at, count)

    @staticmethod
    def _gathered(pool: np.ndarray, at: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        before = np.cumsum(count, dtype=np.int64) - count
        total = int(before[-1] + count[-1]) if len(count) else 0
        return pool[np.repeat(at - before, count) + np.arange(total)], count
