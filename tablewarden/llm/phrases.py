"""Phrases whose words stand together more often than apart, from a weighted de Bruijn graph.

Nodes are pairs of neighbouring words, edges are the triples that lead from
one pair to the next. Every occurrence of a word gives one entry: the triple
that begins there, or what is left of it where the piece ends. So what flows
out of a node, with the pieces that end in it, is the count of the pair, and
what flows out of all pairs with one first word, with the pieces that end in
that word, is the count of the word; no phrase is counted by a pass of its own.

A slice of text adds up its own edges and the flows they give, and deals the
sums over buckets by a hash of the phrase, so a word or a pair with a third of
all occurrences is one entry of a slice. Nodes that pass on all of their flow
from one edge to one other are then compacted: the paths of equal count that
are left are the long fixed phrases.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.llm.common import files_for, saved, ship_package

LEAST_COUNT = 10
#: Of 100 occurrences of a phrase, those within one longer candidate that drop it.
WITHIN_LONGER = 50
MOST_PER_LANG = 2000
NO_LANG = "und"
#: Bytes of text whose edges are added up at once; a longer text is a step of its own.
SLICE_BYTES = 2 << 20
#: Bytes of text for each bucket of sums; a bucket is added up in one step of a task.
BUCKET_BYTES = 4 << 20
#: Phrases in a file of an intermediate table.
PHRASES_PER_FILE = 500_000
#: Words whose edges are added up at once.
CHUNK_WORDS = 1 << 19

#: A slice's sums for one bucket: sizes (int32) and counts (int64) of the phrases, then their bytes, compressed.
PACKED = "bucket long, n_phrases long, payload binary"
PACKED_TYPES = (pa.int64(), pa.int64(), pa.binary())
COUNTS = "lang string, words array<string>, n long"
#: A blank for a tab, a line feed for each mark that ends a piece, small letters for A-Z (fixed values).
PLAIN = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz \n\n\n\n\n\n\n\n\n"
)


def _joined(*columns: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """A number for each row of columns that are not negative, alike for like rows; the columns of each number."""
    known, key = np.unique(columns[0], return_inverse=True)
    parts = [known]
    for column in columns[1:]:
        base = int(column.max()) + 1
        known, key = np.unique(key * base + column, return_inverse=True)
        seen, last = np.divmod(known, base)
        parts = [*(p[seen] for p in parts), last]
    return key, parts


def _flows(ids: np.ndarray, size: int) -> list[tuple[list[np.ndarray], np.ndarray]]:
    """Edges, nodes and words that begin at the first ``size`` places, with their counts, each from the one before.

    ``ids`` are numbers of words from 1 on, with 0 where a piece ends; the two
    behind the places are only looked at.
    """
    padded = np.r_[ids[: size + 2], 0, 0]
    first, second, third = (padded[k : k + min(size, len(ids))] for k in range(3))
    third = np.where(second == 0, 0, third)
    key, edge = _joined(*(c[first > 0] for c in (first, second, third)))
    weight = np.bincount(key)
    out = []
    for width in (3, 2, 1):
        if width < 3:
            key, edge = _joined(*edge[:width])
            # whole numbers below 2**53 are exact in these sums
            weight = np.bincount(key, weights=weight).astype(np.int64)
        whole = edge[-1] > 0
        out.append(([c[whole] for c in edge], weight[whole]))
    return out


def _packed(lang: str, texts: list[str], buckets: int) -> Iterator[tuple[int, int, bytes]]:
    """The sums of one slice of one language, as rows of ``PACKED``."""
    plain = "\n".join(texts).encode("utf-8").translate(PLAIN).replace(b"\n", b" \n ")
    known = pa.array([b"\n", *filter(None, plain.split(b" "))], pa.binary()).dictionary_encode()
    ids, vocabulary = known.indices.to_numpy()[1:].astype(np.int64), known.dictionary
    mixed = np.array([zlib.crc32(w.as_py()) for w in vocabulary], dtype=np.uint64)
    for start in range(0, len(ids), CHUNK_WORDS):
        if ids[start : start + CHUNK_WORDS].any():
            yield from _packed_chunk(lang, _flows(ids[start:], CHUNK_WORDS), vocabulary, mixed, buckets)


def _packed_chunk(
    lang: str, flows: list, vocabulary: pa.Array, mixed: np.ndarray, buckets: int
) -> Iterator[tuple[int, int, bytes]]:
    suffix = lang.encode("utf-8")
    seed = zlib.crc32(suffix)
    place, phrases, counts = [], [], []
    for columns, weight in flows:
        with np.errstate(over="ignore"):
            h = np.full(len(weight), seed, dtype=np.uint64)
            for c in columns:
                h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + mixed[c]
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        place.append(((h >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64))
        text = pc.binary_join_element_wise(*[vocabulary.take(pa.array(c)) for c in columns], b" ")
        phrases.append(pc.binary_join_element_wise(text, pa.scalar(suffix), b"\n"))
        counts.append(weight)
    # all words of the language together
    place.append(np.array([seed % buckets]))
    phrases.append(pa.array([b"\n" + suffix], pa.binary()))
    counts.append(np.array([counts[-1].sum()]))
    place, weight = np.concatenate(place), np.concatenate(counts)
    order = np.argsort(place, kind="stable")
    every = pa.concat_arrays(phrases).take(pa.array(order))
    place, weight = place[order], weight[order]
    ends = np.frombuffer(every.buffers()[1], dtype=np.int32, count=len(every) + 1)
    data = memoryview(every.buffers()[2])
    cuts = np.r_[0, np.flatnonzero(np.diff(place)) + 1, len(place)].tolist()
    squeeze = zstandard.ZstdCompressor(level=1)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        payload = np.diff(ends[a : b + 1]).tobytes() + weight[a:b].tobytes() + bytes(data[ends[a] : ends[b]])
        yield int(place[a]), b - a, squeeze.compress(payload)


def _pack(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(1).nbytes
            rows = max(1, int(batch.num_rows * SLICE_BYTES / max(size, 1)))
            for start in range(0, batch.num_rows, rows):
                by_lang: dict[str, list[str]] = {}
                part = batch.slice(start, rows)
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    by_lang.setdefault(lang, []).append(text)
                for lang, texts in by_lang.items():
                    rows_out = _packed(lang, texts, buckets)
                    while some := list(islice(rows_out, 64)):
                        columns = [pa.array(c, kind) for c, kind in zip(zip(*some, strict=True), PACKED_TYPES, strict=True)]
                        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "n_phrases", "payload"])

    return run


def _bucket_sums(held: list[tuple[int, bytes]], least: int) -> pa.RecordBatch:
    """The phrases of one bucket with ``least`` occurrences or more; totals of languages always."""
    sizes, counts, data = [], [], []
    for n, payload in held:
        raw = zstandard.ZstdDecompressor().decompress(payload)
        sizes.append(np.frombuffer(raw, np.int32, n))
        counts.append(np.frombuffer(raw, np.int64, n, 4 * n))
        data.append(raw[12 * n :])
    offsets = np.r_[0, np.cumsum(np.concatenate(sizes), dtype=np.int64)]
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(data))]
    keys = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, buffers)
    counts = np.concatenate(counts)
    sums = pa.table({"key": keys, "n": counts}).group_by("key").aggregate([("n", "sum")])
    frequent = sums.filter(pc.or_(pc.greater_equal(sums["n_sum"], least), pc.starts_with(sums["key"], b"\n")))
    split = [key.split(b"\n", 1) for key in frequent["key"].to_pylist()]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang.decode("utf-8") for _, lang in split], pa.string()),
            pa.array([phrase.decode("utf-8").split(" ") if phrase else [] for phrase, _ in split], pa.list_(pa.string())),
            pa.array(frequent["n_sum"].to_pylist(), pa.int64()),
        ],
        names=["lang", "words", "n"],
    )


def _sum_up(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            for i, number in enumerate(batch.column(0).to_pylist()):
                if number != bucket and held:
                    yield _bucket_sums(held, least)
                    held = []
                bucket = number
                held.append((batch.column(1)[i].as_py(), batch.column(2)[i].as_py()))
        if held:
            yield _bucket_sums(held, least)

    return run


def phrase_counts(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """``lang``, ``words`` and ``n`` of every phrase of one to three words found ``least`` times or more.

    A row without words holds the number of all words of the language.
    """
    texts = ship_package(docs).select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    packed = texts.mapInArrow(_pack(max(16, -(-size // BUCKET_BYTES))), PACKED)
    dealt = packed.repartition("bucket").sortWithinPartitions("bucket")
    return saved(dealt.mapInArrow(_sum_up(least), COUNTS), "phrase-counts")


def graph(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The frequent nodes (``lang``, ``node``, ``f``) and edges (``lang``, ``phrase``, ``source``, ``target``, ``n``)."""
    text = lambda words: F.array_join(words, " ")
    nodes = counts.where("size(words) = 2").select("lang", text("words").alias("node"), F.col("n").alias("f"))
    edges = counts.where("size(words) = 3").select(
        "lang",
        text("words").alias("phrase"),
        text(F.slice("words", 1, 2)).alias("source"),
        text(F.slice("words", 2, 2)).alias("target"),
        "n",
    )
    return nodes, edges


def compacted(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The edges with their unary paths: ``path`` is the phrase of a path's first edge, ``place`` counts from 0.

    A node is unary if one edge brings all of its flow and one takes all of it
    on, so that no piece begins or ends there; ``last`` says that an edge's
    target is not. The edges of a path have one count. Pointers double their
    reach each round, so a path of k edges takes about log2 k rounds. Pieces
    are finite, so no path is a circle.
    """
    into = edges.groupBy("lang", F.col("target").alias("node")).agg(F.max("n").alias("most_in"))
    out = edges.groupBy("lang", F.col("source").alias("node")).agg(F.max("n").alias("most_out"))
    # an edge with all of the flow is the only one
    unary = nodes.join(into, ["lang", "node"]).join(out, ["lang", "node"]).where("most_in = f and most_out = f")
    files = files_for(edges, edges.count(), PHRASES_PER_FILE)
    unary = saved(unary.select("lang", "node"), "unary-nodes", files)
    before = edges.select("lang", F.col("phrase").alias("path"), F.col("target").alias("source"))
    before = before.join(unary.withColumnRenamed("node", "source"), ["lang", "source"], "left_semi")
    goes_on = unary.select("lang", F.col("node").alias("target"), F.lit(False).alias("last"))
    linked = edges.join(before, ["lang", "source"], "left").join(goes_on, ["lang", "target"], "left")
    kept = ["lang", "phrase", "source", "target", "n"]
    state = linked.select(
        *kept,
        F.coalesce("last", F.lit(True)).alias("last"),
        F.coalesce("path", "phrase").alias("path"),
        F.col("path").isNotNull().cast("long").alias("place"),
    )
    state = saved(state, "phrase-paths", files)
    while True:
        inner = state.where("place > 0").select(
            "lang", F.col("phrase").alias("path"), F.col("path").alias("far"), F.col("place").alias("more")
        )
        moved = state.join(inner, ["lang", "path"], "left").select(
            *kept,
            "last",
            F.coalesce("far", "path").alias("path"),
            (F.col("place") + F.coalesce("more", F.lit(0))).alias("place"),
            F.col("far").isNotNull().alias("moved"),
        )
        moved = saved(moved, "phrase-paths", files)
        state = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return state


def fixed_phrases(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """``lang``, ``phrase``, ``n_words`` and ``n`` of every maximal path: words that always go on alike.

    A path lies within one piece, so the words gathered for it are bounded by
    the longest piece.
    """
    edges = compacted(*graph(phrase_counts(docs, least)))
    words = F.sort_array(F.collect_list(F.struct("place", F.element_at(F.split("phrase", " "), 3).alias("word"))))
    paths = edges.groupBy("lang", "path").agg(words.alias("words"), F.max("n").alias("n"))
    tail = F.transform(F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(1))), lambda w: w.word)
    phrase = F.array_join(F.concat(F.array("path"), tail), " ")
    return paths.select("lang", phrase.alias("phrase"), (F.size("words") + 2).cast("long").alias("n_words"), "n")


def candidates(counts: DataFrame, within: int = WITHIN_LONGER) -> DataFrame:
    """``lang``, ``phrase``, ``a`` and ``cuts`` (k, l, r) of every phrase of two or three words that no longer one drops.

    Within a path the counts of pairs are the path's own, and every such pair
    is dropped; the pairs left are looked up among the nodes.
    """
    nodes, edges = graph(counts)
    edges = compacted(nodes, edges)
    inner = edges.where("place > 0").select("lang", F.col("source").alias("node"))
    files = files_for(nodes, nodes.count(), PHRASES_PER_FILE)
    nodes = saved(nodes.join(inner, ["lang", "node"], "left_anti"), "phrase-nodes", files)
    words = counts.where("size(words) = 1").select("lang", F.col("words")[0].alias("word"), F.col("n").alias("f"))

    ends = [edges.where(where).select("lang", F.col(c).alias("node"), "n") for where, c in (("place = 0", "source"), ("last", "target"))]
    longest = ends[0].unionByName(ends[1]).groupBy("lang", "node").agg(F.max("n").alias("most"))
    pairs = nodes.join(longest, ["lang", "node"], "left").where(F.col("most").isNull() | (F.lit(100) * F.col("most") < F.lit(within) * F.col("f")))

    def counted(rows: DataFrame, name: str, word: Column) -> DataFrame:
        return rows.withColumn("word", word).join(words.withColumnRenamed("f", name), ["lang", "word"]).drop("word")

    def word(phrase: str, i: int) -> Column:
        return F.element_at(F.split(phrase, " "), i)

    cut = lambda k, left, right: F.struct(F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))
    two = counted(counted(pairs, "l1", word("node", 1)), "r1", word("node", 2))
    two = two.select("lang", F.col("node").alias("phrase"), F.col("f").alias("a"), F.array(cut(1, "l1", "r1")).alias("cuts"))
    three = counted(counted(edges, "l1", word("phrase", 1)), "r2", word("phrase", 3))
    for name, node in (("l2", "source"), ("r1", "target")):
        known = nodes.select("lang", F.col("node").alias(node), F.col("f").alias(name))
        three = three.join(known, ["lang", node], "left").withColumn(name, F.coalesce(name, "n"))
    three = three.select("lang", "phrase", F.col("n").alias("a"), F.array(cut(1, "l1", "r1"), cut(2, "l2", "r2")).alias("cuts"))
    return two.unionByName(three)


def collocations(docs: DataFrame, least: int = LEAST_COUNT, within: int = WITHIN_LONGER, most: int = MOST_PER_LANG) -> DataFrame:
    """The ``most`` best phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Letters A-Z count as small ones; pieces end at ``.,;:!?`` and line ends,
    words at blanks and tabs. ``a`` counts the phrase, ``l`` and ``r`` the two
    parts of its lowest-scoring cut (of equal ones the first), ``n`` all words
    of the language; ``score`` is a million times ``a * a / (l * r)``, rounded
    down. Equal scores go by ``a``, then by the bytes of the phrase. A null
    text is empty, a null language ``und``; every row counts, repeated rows
    too, and other columns are not read. A language without candidates, or an
    empty table, gives no rows. Sums are of whole numbers and do not depend on
    the partitions.
    """
    return scored(phrase_counts(docs, least), within, most)


def scored(counts: DataFrame, within: int = WITHIN_LONGER, most: int = MOST_PER_LANG) -> DataFrame:
    """The best phrases from the counts of ``phrase_counts``; the products are decimals of up to 38 digits."""
    total = counts.where("size(words) = 0").select("lang", F.col("n"))
    whole = lambda c: c.cast("decimal(18,0)")
    rows = candidates(counts, within).withColumn("square", F.lit(1_000_000).cast("decimal(7,0)") * whole(F.col("a")) * whole(F.col("a")))
    best = F.array_min(
        F.transform(
            "cuts",
            lambda c: F.struct(F.call_function("div", F.col("square"), whole(c.l) * whole(c.r)).alias("score"), c.k.alias("k"), c.l.alias("l"), c.r.alias("r")),
        )
    )
    rows = rows.withColumn("best", best)
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.join(total, "lang").select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        "phrase",
        "a",
        F.col("best.l").alias("l"),
        F.col("best.r").alias("r"),
        "n",
        F.col("best.score").alias("score"),
    )
