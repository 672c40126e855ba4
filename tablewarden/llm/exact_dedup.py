"""Removal of every byte covered by a long string that also starts elsewhere.

Strings of ``LENGTH`` bytes meet by content. Each of them is filed under the
least hash among the shorter strings of ``ANCHOR`` bytes inside it, so equal
strings are filed alike; neighbours in a text that are filed alike form a run,
and a run with the bytes it covers is a segment.

1. Runs are counted by their key; a key that stands once can't repeat.
2. Equal segments under a key become one row with a count before any text is
   moved. Where a key has a single segment nothing is left to compare.
3. The different segments of a key are dealt to shards and sorted by induced
   suffix sorting (``suffix_sort``): a place that shares ``LENGTH`` bytes with a
   neighbour in suffix order is a repeat. A key with many different segments is
   a shard of its own. One that is larger than a shard is cut again under longer
   anchors, where equal parts are counted and what is left is sorted.
4. The repeats go back to the texts as byte ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import doc_texts, saved
from tablewarden.llm.suffix_sort import repeated_places

LENGTH = 400
ANCHOR = 200
#: Bytes of segments that are sorted at once.
SHARD_BYTES = 2 << 20
#: Different segments of a key from which on it is a shard of its own, or cut again under longer anchors if it has more
#: bytes than a shard.
SEGMENTS_OF_KEY = 200
#: Strings of a text that are looked at together.
BLOCK = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


_power_cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(1 << 16, 1 << (n - 1).bit_length())
    if size not in _power_cache:
        _power_cache[size] = _powers(_BASE, size), _powers(_BACK, size)
    return _power_cache[size]


def hashes(x: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` bytes from each place on."""
    up, back = _power_tables(len(x) + 1)
    sums = np.zeros(len(x) + 1, np.uint64)
    np.cumsum((x.astype(np.uint64) + np.uint64(1)) * up[: len(x)], out=sums[1:])
    h = (sums[length:] - sums[:-length]) * back[: len(x) - length + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def _sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    n = len(h)
    blocks = np.r_[h, np.full(-n % width, ~np.uint64(0))].reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    return np.minimum(behind[:m], ahead[width - 1 : width - 1 + m])


_PLACE = np.uint64((1 << 21) - 1)


def runs_of(data: bytes, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Key, first and last start of each run of strings, and whether strings of the run may be equal to each other.

    They may where the anchor stands twice in the run: then a string holds it
    twice, or the run is longer than one anchor can reach.
    """
    x = np.frombuffer(data, np.uint8)
    inside = length - anchor
    out: list[list[np.ndarray]] = [[], [], [], []]
    # blocks bound the memory for a very long text; a run that they cut is two runs with one key
    for begin in range(0, len(x) - length + 1, BLOCK):
        h = hashes(x[begin : begin + BLOCK + length - 1], anchor)
        place = np.arange(len(h), dtype=np.uint64)
        rough = h & ~_PLACE
        left = (_sliding_least(rough | place, inside + 1) & _PLACE).astype(np.int64)
        right = (_PLACE - (_sliding_least(rough | (_PLACE - place), inside + 1) & _PLACE)).astype(np.int64)
        least = h[left]
        first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        last = np.r_[first[1:], len(least)] - 1
        out[0].append(least[first])
        out[1].append(first + begin)
        out[2].append(last + begin)
        out[3].append(np.logical_or.reduceat(left != right, first) | (last - first > inside))
    kinds = (np.uint64, np.int64, np.int64, bool)
    return tuple(np.concatenate([*v, np.empty(0, k)]).astype(k) for v, k in zip(out, kinds, strict=True))


def _rows(docs: DataFrame) -> DataFrame:
    """Texts known by ``doc_id`` and a hash of the text; rows equal in both are copies of each other."""
    texts = doc_texts(docs)
    return texts.select(
        F.coalesce("doc_id", F.lit(-(2**63))).alias("doc"), F.xxhash64("text").alias("th"), "doc_id", "text"
    )


RUN_SCHEMA = "doc long, th long, lo int, wide int, key long, segment long, inner boolean"


def _runs(rows: DataFrame, length: int, anchor: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for doc, th, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                data = text.as_py().encode("utf-8")
                if len(data) < length:
                    continue
                key, lo, hi, inner = runs_of(data, length, anchor)
                view = memoryview(data)
                sh = [digest(view[a : b + length]) for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
                for k, v in enumerate((np.full(len(key), doc), np.full(len(key), th), lo, hi - lo, key.view(np.int64))):
                    out[k].append(v)
                out[5].append(np.array(sh, np.uint64).view(np.int64))
                out[6].append(inner)
            if out[0]:
                kinds = [np.int64, np.int64, np.int32, np.int32, np.int64, np.int64, bool]
                columns = [pa.array(np.concatenate(v).astype(k)) for v, k in zip(out, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "th", "lo", "wide", "key", "segment", "inner"])

    return rows.select("doc", "th", "text").mapInArrow(find, RUN_SCHEMA)


def _segment_texts(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted segments, cut out of the one text that stands for each."""
    some = F.struct("lo", "wide", "key", "segment", "copies", "sort")
    by_text = wanted.groupBy("doc", "th").agg(F.collect_list(some).alias("some"))
    # of rows that are equal throughout, any one will do
    texts = rows.select("doc", "th", "text").join(by_text, ["doc", "th"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for text, some in zip(batch.column(0), batch.column(1), strict=True):
                data = text.as_py().encode("utf-8")
                for s in some.as_py():
                    row = (s["key"], s["segment"], s["wide"], s["copies"], s["sort"], data[s["lo"] : s["lo"] + s["wide"] + length])
                    for k, v in enumerate(row):
                        out[k].append(v)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(out, kinds, strict=True)],
                names=["key", "segment", "wide", "copies", "sort", "bytes"],
            )

    return texts.select("text", "some").mapInArrow(
        cut, "key long, segment long, wide int, copies long, sort string, bytes binary"
    )


SPAN_SCHEMA = "key long, segment long, wide int, first int, last int"


def _spans(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive places."""
    first = np.flatnonzero(np.r_[True, np.diff(places) != 1]) if len(places) else np.empty(0, np.int64)
    return places[first], places[np.r_[first[1:], len(places)] - 1] if len(places) else places


def _sorted_shards(segments: DataFrame, length: int, shard_bytes: int, alone: bool = False) -> DataFrame:
    """Repeats among the segments of each key, by suffix sorting of shards of whole keys, of one key each if ``alone``."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def shard() -> pa.RecordBatch:
            out: list[list] = [[], [], [], [], []]
            found = repeated_places([row[3] for row in held], length)
            for (key, segment, wide, _), places in zip(held, found, strict=True):
                for a, b in zip(*[v.tolist() for v in _spans(places)], strict=True):
                    for k, v in enumerate((key, segment, wide, a, b)):
                        out[k].append(v)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names=["key", "segment", "wide", "first", "last"]
            )

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and row[0] != held[-1][0] and (alone or size >= shard_bytes):
                    yield shard()
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield shard()

    # a task for each shard or so: sorting costs far more than the bytes suggest
    size = segments.agg(F.sum(F.length("bytes"))).first()[0] or 0
    tasks = max(1, -(-size // shard_bytes))
    dealt = segments.select("key", "segment", "wide", "bytes").repartition(tasks, "key").sortWithinPartitions("key")
    return dealt.mapInArrow(sort, SPAN_SCHEMA)


def _sorted_spans(texts: DataFrame, length: int, anchors: tuple[int, ...], shard_bytes: int) -> DataFrame:
    """Repeats among the segments of each key, as ``SPAN_SCHEMA``, each kind of key in its own way."""
    spans = _sorted_shards(texts.where(F.col("sort") == SHARED), length, shard_bytes)
    kinds = {row[0] for row in texts.select("sort").distinct().collect()}
    if ALONE in kinds:
        # a stage of their own: its tasks are far longer than those of shared shards
        large = _sorted_shards(texts.where(F.col("sort") == ALONE), length, shard_bytes, alone=True)
        spans = spans.unionByName(saved(large, "large-keys"))
    if CUT in kinds:
        spans = spans.unionByName(_cut_again(texts.where(F.col("sort") == CUT), length, anchors, shard_bytes))
    return spans


PIECE = ["key", "segment", "wide"]


def _fine_runs(segments: DataFrame, length: int, anchor: int) -> DataFrame:
    """The segments of large keys, cut again into runs under longer anchors."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, segment, wide, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                fine, lo, hi, inner = runs_of(data, length, anchor)
                view = memoryview(data)
                sh = [xxhash.xxh3_64_intdigest(view[a : b + length]) for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
                n = len(fine)
                columns = [np.full(n, key), np.full(n, segment), np.full(n, wide, np.int32), lo.astype(np.int32)]
                columns += [(hi - lo).astype(np.int32), fine.view(np.int64), np.array(sh, np.uint64).view(np.int64), inner]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns],
                    names=["key", "segment", "wide", "lo", "fine_wide", "fine_key", "fine_segment", "inner"],
                )

    return segments.select("key", "segment", "wide", "bytes").mapInArrow(
        find, "key long, segment long, wide int, lo int, fine_wide int, fine_key long, fine_segment long, inner boolean"
    )


def _cut_again(segments: DataFrame, length: int, anchors: tuple[int, ...], shard_bytes: int) -> DataFrame:
    """Repeats among the segments of keys larger than a shard, as ``SPAN_SCHEMA``.

    They are cut again under longer anchors, which parts what differs and lets
    equal runs fall together as rows with a count. What is left is sorted like
    other segments; a key that is larger than a shard even then is cut once more.
    An anchor that leaves half the room gives a few runs for each segment. Under
    the last anchor, one byte shorter than the strings, a segment that does not
    overlap itself is the anchor and a byte on either side, so that a key has
    at most 2 ** 16 different ones, and it is sorted whatever their number.
    """
    whole = ["fine_key", "fine_segment", "fine_wide"]
    runs = saved(_fine_runs(segments, length, anchors[0]), "fine-runs")
    place = F.struct("key", "segment", "lo").alias("at")
    pieces = runs.groupBy(*whole).agg(F.count("*").alias("copies"), F.min(place).alias("at"), F.max("inner").alias("inner"))
    pieces = saved(pieces, "fine-pieces")
    groups = _to_compare(pieces, "fine_key", "fine_wide", length, shard_bytes if len(anchors) > 1 else None)
    groups = saved(groups, "fine-groups")
    rest = pieces.join(groups, "fine_key").select(*whole, "at.*", "sort")
    rest = rest.join(segments.select("key", "segment", "bytes"), ["key", "segment"])
    data = F.expr(f"substring(bytes, lo + 1, fine_wide + {length})").alias("bytes")
    named = [F.col(w).alias(n) for w, n in zip(whole, PIECE, strict=True)]
    rest = saved(rest.select(*named, "sort", data), "fine-texts")
    spans = _sorted_spans(rest, length, anchors[1:], shard_bytes)
    some = spans.select(*[F.col(n).alias(w) for w, n in zip(whole, PIECE, strict=True)], "first", "last")
    full = pieces.where("copies > 1").select(*whole, F.lit(0).alias("first"), F.col("fine_wide").alias("last"))
    found = saved(full.unionAll(some), "fine-repeats")
    back = runs.join(found, whole)
    return back.select(
        "key", "segment", "wide", (F.col("lo") + F.col("first")).alias("first"), (F.col("lo") + F.col("last")).alias("last")
    )


#: How the segments of a key are sorted: in a shard with other keys, in one of their own, or after they are cut again.
SHARED, ALONE, CUT = "shared", "alone", "cut"


def _to_compare(pieces: DataFrame, key: str, wide: str, length: int, most_bytes: int | None) -> DataFrame:
    """Keys with something to compare, and how they are sorted; none is cut where ``most_bytes`` is not given.

    That is a segment that stands once, beside others or with repeats of its own.
    """
    groups = pieces.groupBy(key).agg(
        F.count("*").alias("different"),
        F.sum(F.col(wide).cast("long") + length).alias("bytes"),
        F.sum((F.col("copies") == 1).cast("long")).alias("single"),
        F.max(F.expr("copies = 1 and inner")).alias("inner"),
    )
    large = F.lit(False) if most_bytes is None else F.col("bytes") > most_bytes
    how = F.when(F.col("different") <= SEGMENTS_OF_KEY, SHARED).when(large, CUT).otherwise(ALONE)
    return groups.where("single > 0 and (different > 1 or inner)").select(key, how.alias("sort"))


def finer_anchors(length: int, anchor: int) -> tuple[int, ...]:
    """The last anchors for large keys: nearly as long as the strings, then one byte shorter."""
    return tuple(sorted({max(anchor, length - max(1, length // 20)), length - 1}))


def longer_anchors(length: int, anchor: int) -> tuple[int, ...]:
    """The anchors under which a large key is cut again: each halves what is left to the strings, then the finer ones."""
    out, left = [], (length - anchor) // 2
    while left > length // 10:
        out.append(length - left)
        left //= 2
    return (*out, *finer_anchors(length, anchor))


def repeated_ranges(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``doc``, ``th`` and ``gone``, the starts of repeated strings as (first, last), for each text that has some."""
    rows = _rows(docs)
    runs = saved(_runs(rows, length, anchor), "runs")
    keys = runs.groupBy("key").agg(F.count("*").alias("n"), F.max("inner").alias("inner"))
    keys = saved(keys.where("n > 1 or inner").select("key"), "keys")
    runs = saved(runs.join(keys, "key"), "runs")

    place = F.struct("doc", "th", "lo")
    segments = runs.groupBy("key", "segment", "wide").agg(F.count("*").alias("copies"), F.min(place).alias("at"), F.max("inner").alias("inner"))
    segments = saved(segments.select("key", "segment", "wide", "copies", "inner", "at.*"), "segments")
    groups = saved(_to_compare(segments, "key", "wide", length, shard_bytes), "groups")
    wanted = segments.join(groups, "key")
    texts = saved(_segment_texts(rows, wanted, length), "segment-texts")
    spans = _sorted_spans(texts, length, longer_anchors(length, anchor), shard_bytes)

    whole = segments.where("copies > 1").select("key", "segment", "wide", F.lit(0).alias("first"), F.col("wide").alias("last"))
    spans = saved(whole.unionAll(spans), "repeats")
    back = runs.join(spans, ["key", "segment", "wide"])
    span = F.struct((F.col("lo") + F.col("first")).alias("first"), (F.col("lo") + F.col("last")).alias("last"))
    # bounded by the places of one text
    return back.groupBy("doc", "th").agg(F.collect_set(span).alias("gone"))


def _cut(data: bytes, gone: list[dict], length: int) -> tuple[bytes, int]:
    """The bytes that no repeated string covers, and the number of removed runs."""
    marks = np.zeros(len(data) + 1, np.int64)
    first = np.array([g["first"] for g in gone], np.int64)
    last = np.array([g["last"] for g in gone], np.int64)
    np.add.at(marks, first, 1)
    np.add.at(marks, last + length, -1)
    covered = np.cumsum(marks[:-1]) > 0
    spans = int(np.count_nonzero(covered & ~np.r_[False, covered[:-1]]))
    return np.frombuffer(data, np.uint8)[~covered].tobytes(), spans


def _merged(spans: Column) -> Column:
    return F.coalesce(spans, F.array().cast("array<struct<first:int,last:int>>"))


def exact_dedup_digests(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``had_repeat`` of every whole text.

    A byte goes if a string of ``length`` bytes over it also starts anywhere
    else, in this text or another; strings are judged on the input. A null text
    is empty. Rows equal in ``doc_id`` and text are copies of each other like
    any other two documents.
    """
    gone = repeated_ranges(docs, length, anchor, shard_bytes)
    rows = _rows(docs).join(gone, ["doc", "th"], "left").select("doc_id", "text", _merged(F.col("gone")).alias("gone"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, n_removed, n_spans, kept = [], [], [], []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                data = text.as_py().encode("utf-8")
                rest, n = _cut(data, spans.as_py(), length) if len(spans) else (data, 0)
                n_bytes.append(len(data))
                n_removed.append(len(data) - len(rest))
                n_spans.append(n)
                kept.append(hashlib.sha256(rest).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *[pa.array(v, pa.int64()) for v in (n_bytes, n_removed, n_spans)],
                    pa.array(kept, pa.string()),
                    pa.array([n > 0 for n in n_spans], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "had_repeat"],
            )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, had_repeat boolean"
    return rows.mapInArrow(cut, schema)
