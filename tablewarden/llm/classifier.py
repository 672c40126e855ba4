"""Quality by the votes of the nearest labelled documents in a latent-semantic space.

A bounded sample of labelled documents gives the space: hashed terms with
tf-idf weights, cut to a few dimensions by a singular value decomposition. The
labelled vectors are broadcast; their number is bounded by ``most_labelled``.
Every document is projected and compared with every labelled vector in blocks
of exact cosine products, and the labels are averaged by similarity.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.llm.common import Known, by_number, doc_texts, ship_package, unused, with_fields

FOLDS = 5
#: Labelled documents that the space is fitted on and that vote, at most.
MOST_LABELLED = 4000
TERMS = 4096
DIMENSIONS = 96
NEIGHBOURS = 25
THRESHOLD = 0.3
BLOCK = 512
#: Bytes of terms kept between batches.
CACHE_BYTES = 32 << 20
#: Terms that a word repeated at once counts for.
REPEAT_TERMS = 6


def in_held_out_fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS == 0


def _shape(word: str) -> str:
    """How a word is written, apart from its letters."""
    out = []
    for c in word:
        kind = "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out[:6])


def _terms_of(word: str) -> tuple[int, ...]:
    """Hashed terms of a word: the lower-cased word, its last letters, its shape and its length."""
    low = word.lower().strip(".,;:!?")
    terms = ("w" + low, "e" + low[-3:], "s" + _shape(word), f"n{min(len(word), 12)}")
    return tuple(zlib.crc32(t.encode("utf-8")) % TERMS for t in terms)


_terms = Known(_terms_of, CACHE_BYTES)


def term_counts(text: str) -> np.ndarray:
    """Counts of the hashed terms of a whole text, and of how its lines and words repeat."""
    words = text.split()
    flat = [t for w in words for t in _terms[w]]
    out = np.bincount(np.array(flat, np.int64), minlength=TERMS).astype(np.float32)
    if words:
        lines = [x for x in text.split("\n") if x.strip()]
        # repetition as terms: the share of repeated lines and of repeated word triples
        triples = list(zip(words, words[1:], words[2:], strict=False))
        for name, n, distinct in (("lines", len(lines), len(set(lines))), ("triples", len(triples), len(set(triples)))):
            if n:
                step = round(10 * (n - distinct) / n)
                out[zlib.crc32(f"repeat {name} {step}".encode()) % TERMS] += len(words)
        again = sum(a == b for a, b in zip(words, words[1:], strict=False))
        for k in range(REPEAT_TERMS):
            out[zlib.crc32(f"again {k}".encode()) % TERMS] += again
    return out


@dataclass
class Model:
    """Everything a worker needs; its size is bounded by the parameters alone."""

    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def weights(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts)
        x *= self.idf
        x /= np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x))[:, None], 1e-9)
        return x

    def project(self, weights: np.ndarray) -> np.ndarray:
        z = weights @ self.basis
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Between 0 and 1; without labelled documents or words the prior."""
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        cosine = self.project(self.weights(counts)) @ self.vectors.T
        k = min(NEIGHBOURS, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        similarity = np.clip(np.take_along_axis(cosine, near, axis=1), 0, None).astype(np.float64) ** 4
        total = similarity.sum(axis=1)
        vote = (similarity * self.labels[near]).sum(axis=1)
        out = np.where(total > 1e-12, vote / np.maximum(total, 1e-12), self.prior)
        out[counts.sum(axis=1) == 0] = self.prior
        return np.clip(out, 0.0, 1.0)


def fit_model(counts: np.ndarray, labels: np.ndarray, seed: int = 7) -> Model:
    """The space and the voters, from the term counts of the sampled labelled documents."""
    n = len(counts)
    prior = float(labels.mean()) if n else 0.5
    if not n:
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), labels, prior)
    idf = np.log((1 + n) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 0.1
    model = Model(idf, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), labels.astype(np.float64), prior)
    x = model.weights(counts)
    # randomised range finder with power steps, then a small exact decomposition
    k = min(DIMENSIONS, n, TERMS)
    q = np.random.default_rng(seed).standard_normal((TERMS, min(k + 16, n))).astype(np.float32)
    for _ in range(3):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    model.basis = np.ascontiguousarray((q @ vt.T)[:, :k], np.float32)
    model.vectors = model.project(x).astype(np.float32)
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Term counts and labels of at most ``most`` documents outside the held-out fold, drawn by the hash of their id.

    The bound holds whatever the size of the tables: ids are drawn from the
    narrow table, and the driver gets a fixed number of counts for each, never
    a text. Labels without a value, and ids with more than one, are left out.
    """
    named = labels.where("quality is not null and doc_id is not null").where(~in_held_out_fold(F.col("doc_id")))
    named = named.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").alias("quality"), F.max("quality").alias("other")
    )
    drawn = named.where("quality = other").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id", "quality")
    texts = doc_texts(docs).join(F.broadcast(drawn), "doc_id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [term_counts(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(rows, pa.binary())], names=["doc_id", "quality", "counts"]
            )

    counted = texts.select("doc_id", "text", F.col("quality").cast("long").alias("quality"))
    counted = counted.mapInArrow(count, "doc_id long, quality long, counts binary")
    # one text for an id, should it stand in several rows
    rows = counted.groupBy("doc_id").agg(F.min("counts").alias("counts"), F.first("quality").alias("quality"))
    found = sorted(rows.collect(), key=lambda r: r.doc_id)
    labels = np.array([r.quality for r in found], np.int64)
    counts = np.empty((len(found), TERMS), np.float32)
    for k in range(len(found) - 1, -1, -1):
        counts[k] = np.frombuffer(found.pop().counts, np.float32)
    return counts, labels


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs``, and as the last one the score of every whole text; a null text counts as empty.

    The score is named ``__score``, with more underscores where ``docs`` has
    such a column.
    """
    ship_package(docs)
    (name,) = unused(docs, "__score")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                counts = np.stack([term_counts(t.as_py() or "") for t in part.column(at)])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(m.scores(counts))], names=[*part.schema.names, "score"]
                )

    rows = by_number(docs)
    return rows.mapInArrow(score, with_fields(rows, score="double")).toDF(*docs.columns, name)


def fitted(docs: DataFrame, labels: DataFrame) -> Model:
    return fit_model(*labelled_sample(docs, labels))


def classify(docs: DataFrame, labels: DataFrame, train_docs: DataFrame | None = None) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document.

    Scores depend on the text alone. Without any labelled document every score
    is one half; an empty text gets the share of good labels. Repeated rows
    stay repeated.
    """
    scored = score_documents(doc_texts(docs), fitted(docs if train_docs is None else train_docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(in_held_out_fold(F.col("doc_id")), F.lit(False)).alias("held_out"),
        F.col("__score").alias("score"),
        F.when(F.col("__score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
