"""Line dedup by overlapping windows of three lines.

Lines that hold a visible character are taken in threes, each window one line
on from the one before. Of every window that occurs again anywhere, the first
occurrence (by ``doc_id``, then line) stays; the lines of all later occurrences
go, overlapping windows merged. Blank lines between kept lines stay.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import by_number, by_slices, ship_package, unused, with_fields

LINES = 3
BLANK = " \t\n\x0b\x0c\r"


def _with_key(docs: DataFrame, doc_id: Column, text: Column) -> DataFrame:
    """Rows are known by ``doc_id`` and the hash of the text; rows equal in both are treated alike.

    A missing ``doc_id`` comes last in the order.
    """
    return ship_package(docs).withColumns(
        {"__id": F.coalesce(doc_id.cast("long"), F.lit(2**63 - 1)), "__hash": F.xxhash64(F.coalesce(text, F.lit("")))}
    )


def windows(docs: DataFrame, lines: int = LINES, short_texts: bool = False) -> DataFrame:
    """Every window: the row's key, two hashes, and the numbers of its lines.

    With ``short_texts`` a text of fewer lines is one window.
    """

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, hashes, a, b, at = [], [], [], [], []
        digest = xxhash.xxh3_128_intdigest
        for key, text_hash, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            held = [(i, x) for i, x in enumerate(text.split("\n")) if x.strip(BLANK)]
            n = len(held) - lines + 1
            for k in range(max(n, 1) if short_texts and held else n):
                some = held[k : k + lines]
                h = digest("\n".join([x for _, x in some]))
                ids.append(key)
                hashes.append(text_hash)
                a.append((h >> 64) - (1 << 63))
                b.append((h & (2**64 - 1)) - (1 << 63))
                at.append([i for i, _ in some])
        kinds = [pa.int64()] * 4 + [pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip([ids, hashes, a, b, at], kinds, strict=True)],
            names=["__id", "__hash", "a", "b", "lines"],
        )

    texts = _with_key(docs.select("doc_id", "text"), F.col("doc_id"), F.col("text")).select("__id", "__hash", F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(by_slices(of), "__id long, __hash long, a long, b long, lines array<int>")


def repeated_lines(docs: DataFrame, lines: int = LINES, short_texts: bool = False) -> DataFrame:
    """Numbers of the lines to remove, a row for each document that loses some."""
    every = windows(docs, lines, short_texts)
    place = F.struct("__id", "__hash", "lines")
    # minima in partial aggregates: a window that stands everywhere is no list anywhere
    first = every.groupBy("a", "b").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = every.join(first.select("a", "b", "first"), ["a", "b"]).where(place != F.col("first"))
    # sets, so that what is gathered for a key is bounded by the lines of one text, however often its row repeats
    return later.groupBy("__id", "__hash").agg(F.array_distinct(F.flatten(F.collect_set("lines"))).alias("__gone"))


def remove_repeated_lines(docs: DataFrame, lines: int = LINES, short_texts: bool = False) -> DataFrame:
    """All columns of ``docs``, with the repeated lines cut out of ``text``, and two counts as last columns.

    The counts are of the lines with a visible character and of those removed;
    their names are ``__n_lines`` and ``__n_removed``, with more underscores
    where ``docs`` has such columns. A null text stays null; texts of fewer
    than three such lines stay whole, unless ``short_texts`` lets each be one
    window of all its lines. Rows are never dropped here, and other columns
    are kept as they are.
    """
    rows = by_number(docs)
    names, at, gone_at = rows.columns, docs.columns.index("text"), len(docs.columns)
    keyed = _with_key(rows, F.col(names[docs.columns.index("doc_id")]), F.col(names[at]))
    marked = keyed.join(repeated_lines(docs, lines, short_texts), ["__id", "__hash"], "left").drop("__id", "__hash")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, n_lines, n_removed = [], [], []
        for text, gone in zip(batch.column(at).to_pylist(), batch.column(gone_at).to_pylist(), strict=True):
            split = (text or "").split("\n")
            n_lines.append(sum(1 for x in split if x.strip(BLANK)))
            n_removed.append(len(gone or ()))
            if gone:
                gone = set(gone)
                text = "\n".join([x for i, x in enumerate(split) if i not in gone])
            texts.append(text)
        columns = list(batch.columns)
        columns[at] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays(
            [*columns[:gone_at], pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())],
            names=[*names, "n_lines", "n_removed"],
        )

    out = marked.mapInArrow(by_slices(cut, text=names[at]), with_fields(rows, n_lines="long", n_removed="long"))
    return out.toDF(*docs.columns, *unused(docs, "__n_lines", "__n_removed"))


def line_dedup_digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_removed`` and the digest of what is left of every text.

    A null text counts as empty and loses nothing, and neither does a text of
    fewer than three visible lines. Rows with one ``doc_id`` go by the hash of
    their text; rows that repeat throughout, with or without a ``doc_id``, are
    cut alike, since the first occurrence is one for all of them. Other
    columns are not read. An empty table gives no rows.
    """
    return remove_repeated_lines(docs.select("doc_id", "text")).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_removed").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def oracle(source: str = "documents") -> str:
    """DuckDB SQL for the rows of ``line_dedup_digests``, where ``doc_id`` is unique."""
    return rf"""
    WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM {source}),
    held AS (
        SELECT doc_id, line, i, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
        FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
    three AS (
        SELECT doc_id, k, count(*) OVER w AS n, string_agg(line, chr(10)) OVER w AS t FROM held
        WINDOW w AS (PARTITION BY doc_id ORDER BY k ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)),
    later AS (
        SELECT doc_id, k FROM three WHERE n = 3
        QUALIFY row_number() OVER (PARTITION BY t ORDER BY doc_id, k) > 1),
    gone AS (
        SELECT DISTINCT h.doc_id, h.i FROM held h JOIN later l
        ON h.doc_id = l.doc_id AND h.k BETWEEN l.k AND l.k + 2),
    kept AS (
        SELECT l.doc_id, string_agg(line, chr(10) ORDER BY i) AS t FROM lines l ANTI JOIN gone g
        ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id)
    SELECT d.doc_id, coalesce(h.n, 0) AS n_lines, coalesce(g.n, 0) AS n_removed,
           sha256(coalesce(k.t, '')) AS kept_sha256
    FROM {source} d LEFT JOIN kept k USING (doc_id)
    LEFT JOIN (SELECT doc_id, count(*) AS n FROM held GROUP BY doc_id) h USING (doc_id)
    LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g USING (doc_id)"""
