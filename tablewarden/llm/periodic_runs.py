"""Stretches of words that repeat with a period, by a suffix automaton and link-cut access.

Of each text the words are numbered. A run of at least ``least`` words with a
period of at most half its length holds two equal windows of ``least // 2``
words for every word in it, so words that no repeated window covers belong to
no run and part the text into stretches; most texts have none. Each stretch
gets a suffix automaton. Its words are appended one after the other: the path
from the state of the new prefix to the root falls into segments by where
their strings ended last, and is recoloured with the new end. A segment that
ended ``d`` words ago and whose longest string has ``d`` words or more is a
square; its left end is as far as the period goes, and the last end at which
it is seen is the right one. The paths are kept in splay trees, so that a text
of one word over and over takes n log n steps as well.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import by_slices, doc_texts

#: Words of the shortest run.
LEAST_WORDS = 12
#: Bytes of text that one step of a worker takes at once; a longer text is a step of its own.
SLICE_BYTES = 4 << 20

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS_SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class SuffixAutomaton:
    """States of all substrings: the longest length, the suffix link, and the state of each prefix."""

    def __init__(self, symbols: Sequence[int]):
        length, link, after = [0], [-1], [{}]
        prefixes = []
        last = 0
        for symbol in symbols:
            state = len(length)
            length.append(length[last] + 1)
            link.append(0)
            after.append({})
            p = last
            while p >= 0 and symbol not in after[p]:
                after[p][symbol] = state
                p = link[p]
            if p >= 0:
                q = after[p][symbol]
                if length[p] + 1 == length[q]:
                    link[state] = q
                else:
                    copy = len(length)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    after.append(after[q].copy())
                    while p >= 0 and after[p].get(symbol) == q:
                        after[p][symbol] = copy
                        p = link[p]
                    link[q] = link[state] = copy
            last = state
            prefixes.append(state)
        self.length, self.link, self.prefixes = length, link, prefixes


class LastEnds:
    """Link-cut paths over the suffix links of states with at least ``shallowest`` words.

    All states of a path ended last at the same place. Shallower states cannot
    give a run and are left out, so the links form a forest.
    """

    def __init__(self, automaton: SuffixAutomaton, shallowest: int):
        self.length = length = automaton.length
        n = len(length)
        self.left, self.right = [-1] * n, [-1] * n
        self.up = [p if p > 0 and length[p] >= shallowest else -1 for p in automaton.link]
        #: the last end, held by the root of each path's splay tree
        self.end = [-1] * n

    def _inner(self, x: int) -> bool:
        p = self.up[x]
        return p >= 0 and (self.left[p] == x or self.right[p] == x)

    def _splay(self, x: int) -> None:
        left, up = self.left, self.up
        while self._inner(x):
            p = up[x]
            if self._inner(p):
                g = up[p]
                self._rotate(p if (left[p] == x) == (left[g] == p) else x)
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        """Turns x over its parent; what becomes the root takes the old root's end along."""
        left, right, up = self.left, self.right, self.up
        p = up[x]
        g = up[p]
        if left[p] == x:
            y = left[p] = right[x]
            right[x] = p
        else:
            y = right[p] = left[x]
            left[x] = p
        if y >= 0:
            up[y] = p
        up[p], up[x] = x, g
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x
        self.end[x] = self.end[p]

    def append(self, state: int, end: int) -> list[tuple[int, int]]:
        """Recolours the path to ``state`` with ``end``; longest length and last end of each segment before."""
        right, up, ends, length = self.right, self.up, self.end, self.length
        segments = []
        below, x = -1, state
        while x >= 0:
            self._splay(x)
            before = ends[x]
            if before >= 0:
                segments.append((length[x], before))
            if right[x] >= 0:
                ends[right[x]] = before
            right[x] = below
            below, x = x, up[x]
        if below >= 0:
            ends[below] = end
        return segments


def find_runs(words: Sequence[int], least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """Every run as (start, length, smallest period), by start and period.

    A run has at least ``least`` words and twice its period, and goes on in
    neither direction.
    """
    automaton = SuffixAutomaton(words)
    shallowest = max(1, -(-least // 2))
    paths = LastEnds(automaton, shallowest)
    length = automaton.length
    last: dict[tuple[int, int], int] = {}
    for end, state in enumerate(automaton.prefixes):
        if length[state] < shallowest:
            continue
        for longest, before in paths.append(state, end):
            period = end - before
            if longest >= period and longest + period >= least:
                # a longer run with this start and period overwrites a shorter one
                last[end - longest - period + 1, period] = end
    return sorted((start, end - start + 1, period) for (start, period), end in last.items())


def _repeated_windows(ids: np.ndarray, doc: np.ndarray, width: int) -> np.ndarray:
    """True for each word that a window found twice in its document covers.

    Windows meet by a 64-bit hash. A collision covers a word too many, which
    costs time and changes nothing.
    """
    covered = np.zeros(len(ids), dtype=bool)
    n = len(ids) - width + 1
    if n < 2:
        return covered
    with np.errstate(over="ignore"):
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        hashes = doc[:n].astype(np.uint64) * np.uint64(0x94D049BB133111EB)
        for k in range(width):
            hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + mixed[k : k + n]
    places = np.flatnonzero(doc[:n] == doc[width - 1 :])
    order = places[np.argsort(hashes[places], kind="stable")]
    equal = hashes[order[1:]] == hashes[order[:-1]]
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    for k in range(width):
        covered[k : k + n] |= twice
    return covered


def _runs_of_batch(least: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1)
        words = [text.as_py().encode("utf-8").split() for text in texts]
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        every = pa.array([w for ws in words for w in ws], pa.binary())
        ids = every.dictionary_encode().indices.to_numpy()
        doc = np.repeat(np.arange(len(words)), sizes)
        covered = _repeated_windows(ids, doc, max(1, least // 2))
        # stretches of covered words, cut where a document ends
        edge = np.flatnonzero(covered & ~(np.r_[False, covered[:-1]] & np.r_[False, doc[1:] == doc[:-1]]))
        stop = np.flatnonzero(covered & ~(np.r_[covered[1:], False] & np.r_[doc[1:] == doc[:-1], False])) + 1
        runs: list[list[dict]] = [[] for _ in words]
        collapsed = texts.to_pylist()
        for d, ws in enumerate(words):
            collapsed[d] = b" ".join(ws)
        for a, b in zip(edge.tolist(), stop.tolist(), strict=True):
            if b - a >= least:
                d = int(doc[a])
                for start, length, period in find_runs(ids[a:b].tolist(), least):
                    runs[d].append({"start": start + a - int(starts[d]), "length": length, "period": period})
        for d, found in enumerate(runs):
            if found:
                kept = np.ones(len(words[d]), dtype=bool)
                for r in found:
                    kept[r["start"] + r["period"] : r["start"] + r["length"]] = False
                collapsed[d] = b" ".join([words[d][i] for i in np.flatnonzero(kept)])
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(sizes),
                pa.array(runs, pa.list_(RUN)),
                pa.array(collapsed, pa.binary()).cast(pa.string()),
            ],
            names=["doc_id", "n_words", "runs", "collapsed"],
        )

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """``doc_id``, ``n_words``, every run, and the text without what repeats.

    Words are what stands between ASCII white space. ``collapsed`` holds the
    words that no run contains after its first period, joined by one blank. A
    null, empty or blank text has no words and an empty ``collapsed``. Every
    row gives a row, repeated rows and rows without a ``doc_id`` too; other
    columns are not read. Texts are taken whole; a very long one is a step of
    its own, and its memory grows with its longest stretch of repeated words.
    """
    if least < 2:
        raise ValueError("a run has two words at least")
    return doc_texts(docs).mapInArrow(by_slices(_runs_of_batch(least), limit=SLICE_BYTES), RUNS_SCHEMA)


def with_made_periods(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the text; in one of ten documents the words from some place on repeat with a period.

    Place and period follow from the CRC-32 of the decimal ``doc_id``; a
    document without an id or without words stays as it is.
    """
    crc = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = doc_texts(docs).withColumn("hash", crc).withColumn("words", F.when(F.col("hash") % 10 == 0, words))
    n = F.nullif(F.size("words"), F.lit(0))
    seed = F.floor(F.col("hash") / 10)
    first = (seed % n).cast("int")
    period = (F.lit(1) + F.floor((n - first) / (F.lit(3) + seed % 8))).cast("int")

    def word(i: Column) -> Column:
        return F.element_at("words", F.when(i < first, i).otherwise(first + (i - first) % period) + 1)

    made = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), word), " ")
    return rows.select("doc_id", F.when((F.col("hash") % 10 == 0) & (n > 0), made).otherwise(F.col("text")).alias("text"))


def run_digests(docs: DataFrame) -> DataFrame:
    """The longest run of each document, and digests of all its runs and of what is left."""
    found = periodic_runs(with_made_periods(docs))
    longest = F.try_element_at(
        F.transform(
            F.array_sort(F.transform("runs", lambda r: F.struct(-r.length, r.start, r.period))),
            lambda r: F.struct(r.start.alias("start"), (-r.col1).alias("length"), r.period.alias("period")),
        ),
        F.lit(1),
    )
    line = lambda r: F.format_string("%d,%d,%d\n", r.start, r.length, r.period)
    listed = F.array_join(F.transform("runs", line), "")
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        F.col("longest.length").alias("length"),
        F.col("longest.period").alias("period"),
        F.floor(F.lit(1000) * F.col("longest.length") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        "n_words",
    )
