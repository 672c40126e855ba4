"""Benchmark decontamination by the q-gram lemma.

A text that holds an item of length m with at most e edits shares m - q + 1 - q e
q-grams with it, and those lie on diagonals (place in the text less place in
the item) that spread over at most e + 1 values. Diagonals are counted in bands
of twice that width, each overlapping the next by half, so one band holds the
whole occurrence. Bands that reach the bound are aligned with the item, inside
the band, and kept if the distance is within the budget.

Both sides are compared in lower case, letters and digits only, with one blank
between words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import by_number, by_slices, doc_texts, ship_package

#: Edits allowed, as a share of an item's characters.
EDIT_SHARE = 0.1
GRAM = 8
#: Characters of benchmark items that are broadcast at once; larger benchmarks go in several passes.
BLOCK_CHARS = 4_000_000
SLICE_BYTES = 1 << 20
_WORDS = re.compile(r"[^\W_]+")
_BASE, _MIX = np.uint64(1_000_003), np.uint64(0x9E3779B97F4A7C15)
_FLAG_BITS = 22


def plain(text: str) -> str:
    """Lower-case letters and digits, one blank between words."""
    return " ".join(_WORDS.findall(text.lower()))


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def grams(x: np.ndarray, q: int) -> np.ndarray:
    """A hash of the q characters from each place on."""
    n = len(x) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(q):
        out *= _BASE
        out += x[j : n + j]
    return out * _MIX


@dataclass
class Grams:
    """The q-grams of all items that use one q, sorted by hash."""

    q: int
    hashes: np.ndarray
    starts: np.ndarray
    items: np.ndarray
    places: np.ndarray
    flags: np.ndarray


class ItemIndex:
    def __init__(self, items: list[tuple[int, str]], edit_share: float = EDIT_SHARE, gram: int = GRAM):
        held = [(i, plain(t or "")) for i, t in items]
        held = [(i, codes(t)) for i, t in held if t]
        self.ids = np.array([i for i, _ in held], np.int64)
        self.texts = [t for _, t in held]
        self.sizes = np.array([len(t) for t in self.texts], np.int64)
        self.budgets = (self.sizes * edit_share).astype(np.int64)
        # as long a gram as leaves at least one shared gram
        self.q = np.minimum(gram, self.sizes // (self.budgets + 1))
        self.least = self.sizes - self.q + 1 - self.q * self.budgets
        self.most_edits = int(self.budgets.max(initial=0))
        self.tables = [self._table(int(q)) for q in np.unique(self.q)]

    def _table(self, q: int) -> Grams:
        own = np.flatnonzero(self.q == q)
        found = [grams(self.texts[k], q) for k in own]
        h = np.concatenate(found)
        items = np.repeat(own, [len(x) for x in found])
        places = np.concatenate([np.arange(len(x)) for x in found])
        order = np.argsort(h, kind="stable")
        h, items, places = h[order], items[order], places[order]
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        flags = np.zeros(1 << _FLAG_BITS, bool)
        flags[h >> np.uint64(64 - _FLAG_BITS)] = True
        return Grams(q, h[first], np.r_[first, len(h)], items, places, flags)

    def _bands(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items and bands whose counts reach the bound."""
        out = []
        for table in self.tables:
            h = grams(x, table.q)
            at = np.flatnonzero(table.flags[h >> np.uint64(64 - _FLAG_BITS)])
            h = h[at]
            k = np.minimum(np.searchsorted(table.hashes, h), len(table.hashes) - 1)
            hit = table.hashes[k] == h
            at, k = at[hit], k[hit]
            n = table.starts[k + 1] - table.starts[k]
            entry = np.repeat(table.starts[k], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            item = table.items[entry]
            diagonal = np.repeat(at, n) - table.places[entry]
            band = diagonal // (self.budgets[item] + 1)
            # diagonals may be negative by up to an item's length: shift them
            both = np.concatenate([item * (1 << 40) + band + (1 << 39), item * (1 << 40) + band - 1 + (1 << 39)])
            keys, counts = np.unique(both, return_counts=True)
            item = keys >> 40
            keep = counts >= self.least[item]
            out.append((item[keep], (keys[keep] & ((1 << 40) - 1)) - (1 << 39)))
        return np.concatenate([i for i, _ in out]), np.concatenate([b for _, b in out])

    def _align(self, x: np.ndarray, item: np.ndarray, band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least edits of each item within its band, and where the occurrence ends.

        One row of the alignments for each character of the items, all
        candidates at once. Column k is the diagonal k of the band, which is
        wider by the budget on either side.
        """
        size, budget = self.sizes[item], self.budgets[item]
        width = int((2 * (budget + 1) + 2 * budget).max())
        low = band * (budget + 1) - budget
        texts = np.zeros((len(item), int(size.max())), np.uint32)
        for row, k in enumerate(item.tolist()):
            texts[row, : self.sizes[k]] = self.texts[k]
        pad = int(width + size.max() + 2 + max(0, -int(low.min())))
        padded = np.concatenate([np.zeros(pad, np.uint32), x, np.zeros(pad, np.uint32)])
        columns = np.arange(width)
        start = low[:, None] + pad + columns
        row = np.zeros((len(item), width), np.int32)
        edits = np.full(len(item), 1 << 30, np.int64)
        end = np.zeros(len(item), np.int64)
        for i in range(int(size.max())):
            same = padded[np.minimum(start + i, len(padded) - 1)] == texts[:, i : i + 1]
            new = row + ~same
            np.minimum(new[:, :-1], row[:, 1:] + 1, out=new[:, :-1])
            row = np.minimum.accumulate(new - columns, axis=1) + columns
            done = np.flatnonzero(size == i + 1)
            if len(done):
                best = row[done].argmin(axis=1)
                edits[done] = row[done, best]
                end[done] = low[done] + i + 1 + best
        return edits, end

    def _whole_words(self, text: str, item: int, end: int) -> bool:
        """Whether what ends here begins and ends with a word."""
        begin = end - int(self.sizes[item])
        return (begin == 0 or text[begin - 1] == " ") and (end == len(text) or text[end] == " ")

    def matches(self, texts: list[str]) -> list[tuple[int, int, int, int]]:
        """Row of the text, item, edits and end (in the plain text) of the best occurrence of each item."""
        if not self.texts:
            return []
        # more separators than edits: no alignment reaches from one text into the next
        gap = "\0" * (self.most_edits + 1)
        held = [plain(t) for t in texts]
        starts = np.cumsum([0, *[len(t) + len(gap) for t in held]])
        x = codes(gap.join(held))
        item, band = self._bands(x)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for at in range(0, len(item), 256):
            some, its_band = item[at : at + 256], band[at : at + 256]
            edits, end = self._align(x, some, its_band)
            for k, e, stop in zip(some.tolist(), edits.tolist(), end.tolist(), strict=True):
                if e <= self.budgets[k]:
                    row = int(np.searchsorted(starts, stop - 1, side="right")) - 1
                    if not self.budgets[k] and not self._whole_words(held[row], k, stop - int(starts[row])):
                        continue
                    key, value = (row, int(self.ids[k])), (e, stop - int(starts[row]))
                    best[key] = min(value, best.get(key, value))
        return [(row, k, e, stop) for (row, k), (e, stop) in sorted(best.items())]


def _passes(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[ItemIndex]:
    """Indexes over blocks of the benchmark, each of a bounded number of characters."""
    named = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = named.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * total // block_chars)) if total > block_chars else 1
    for block in range(blocks):
        rows = named.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).distinct()
        yield ItemIndex(sorted((r.item_id if r.item_id is not None else -1, r.text) for r in rows.collect()))


def find_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``item_id``, ``edits`` and ``end`` for every item that a whole text holds.

    One row for a text and an item: the occurrence with the fewest edits, then
    the first; ``end`` counts characters of the plain text. Null and empty texts
    hold nothing; items without letters or digits are found nowhere. An item too
    short for an edit, of fewer than ten characters, is found as whole words
    only. Rows without a ``doc_id`` are searched like any other, an item without
    an id has the id -1, and items with one id and different texts are items of
    their own of which the best counts. Repeated rows give repeated results.
    """
    found = None
    for index in _passes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def rows(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            hits = shared.value.matches(batch.column(1).to_pylist())
            at, item, edits, end = (np.array([h[k] for h in hits], np.int64) for k in range(4))
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.array(item), pa.array(edits), pa.array(end)],
                names=["doc_id", "item_id", "edits", "end"],
            )

        part = doc_texts(docs).mapInArrow(by_slices(rows, limit=SLICE_BYTES), "doc_id long, item_id long, edits long, end long")
        found = part if found is None else found.unionAll(part)
    return found


def without_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text holds no item, all columns unchanged."""
    at, names = ship_package(docs).columns.index("text"), docs.columns
    docs = by_number(docs)
    for index in _passes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def clean(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            hits = shared.value.matches([t or "" for t in batch.column(at).to_pylist()])
            keep = np.ones(batch.num_rows, bool)
            keep[[h[0] for h in hits]] = False
            return batch.filter(pa.array(keep))

        docs = docs.mapInArrow(by_slices(clean, text=docs.columns[at], limit=SLICE_BYTES), docs.schema)
    return docs.toDF(*names)
