"""Token ids in files: encoded, compressed by grammars, written, read back.

Documents are dealt out by ranges of ``doc_id``, so the files are in ascending
order and no task sees more than its range. A range is cut into shards of a
bounded number of ids, each with a grammar of its own; a shard is one row of a
Parquet table in the shared folder, written by Spark's own committer, so a lost
executor only repeats its tasks. The starts come from the sizes of the shards,
a table of a few numbers for each some million ids.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewarden.llm import repair
from tablewarden.llm.bpe import byte_letters
from tablewarden.llm.byte_words import WORDS, WordTable, word_starts
from tablewarden.llm.common import doc_texts, vocabulary_path
from tablewarden.session import scratch_dir

BYTE_VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
SHARD_IDS = 2_000_000
#: Bits of a shard's number that count within a range.
RANGE_BITS = 24

#: Bytes of texts that are encoded at once; a longer text, or one with a longer word than that, goes to a library.
SLICE_BYTES = 512 << 10
LONGEST_WORD = 1 << 12
#: Slices that go to a library whole after one with mostly new words.
SLICES_WHOLE = 8

SHARD_SCHEMA = "shard long, n_docs long, n_ids long, doc_ids array<long>, payload binary"


class WordEncoder:
    """The ids of a text under a byte-level vocabulary.

    Where the ids rise along the merges and every byte has one, the ids are the
    ranks as well, and a library for such ranks gives the same ids in less
    time. Texts are cut into words together and each new word is given to that
    library; texts that can't be cut so go to it whole.
    """

    def __init__(self, path: str):
        from tiktoken import _tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {t["content"]: np.array([t["id"]], "<u4") for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        if spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["post_processor"]:
            raise ValueError("not a plain byte-level vocabulary")
        model = spec["model"]
        made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        plain = {t: i for t, i in model["vocab"].items() if t not in self.special}
        singles = [i for t, i in plain.items() if len(t) == 1]
        rising = len(singles) == 256 and len(plain) == 256 + len(made) and max(singles) < min(made)
        if not (rising and all(a < b for a, b in zip(made, made[1:], strict=False))) or model.get("ignore_merges"):
            raise ValueError("the ids do not follow the merges")
        bytes_of = {letter: b for b, letter in enumerate(byte_letters())}
        ranks = {bytes(bytes_of[c] for c in t): i for t, i in plain.items()}
        self.core = _tiktoken.CoreBPE(ranks, {}, WORDS)
        self.table, self.whole = WordTable(self.core.encode_single_piece), 0
        self.size = 1 + max([*plain.values(), *(int(i[0]) for i in self.special.values())])

    def _encode_part(self, text: str) -> np.ndarray:
        try:
            return np.frombuffer(self.core.encode_to_tiktoken_buffer(text, set()), "<u4")
        except ValueError:  # its matcher gives up on very long white space
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def encode(self, text: str) -> np.ndarray:
        if not any(s in text for s in self.special):
            return self._encode_part(text)
        parts = self.cut.split(text)
        return np.concatenate([self.special[p] if k % 2 else self._encode_part(p) for k, p in enumerate(parts)])

    def encode_all(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        held: list[bytes] = []
        size = 0
        for text in texts:
            data = text.encode("utf-8")
            if held and size + len(data) > SLICE_BYTES:
                yield from self._encode_slice(held)
                held, size = [], 0
            held.append(data)
            size += len(data)
        yield from self._encode_slice(held)

    def _encode_slice(self, texts: list[bytes]) -> list[np.ndarray]:
        data = b"".join(texts)
        if not data:
            return [np.empty(0, "<u4")] * len(texts)
        if len(data) > SLICE_BYTES or any(s.encode("utf-8") in data for s in self.special):
            if len(texts) == 1:
                return [self.encode(data.decode("utf-8"))]
            return [ids for t in texts for ids in self._encode_slice([t])]
        if self.whole:
            self.whole -= 1
            return [self.encode(t.decode("utf-8")) for t in texts]
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes)
        starts, unknown = word_starts(np.frombuffer(data, np.uint8), (ends - sizes)[sizes > 0])
        stops = np.r_[starts[1:], len(data)]
        whole = {*np.searchsorted(ends, unknown, "right").tolist()}
        whole |= {*np.searchsorted(ends, starts[stops - starts > LONGEST_WORD], "right").tolist()}
        if whole:  # they have no word here
            here = ~np.isin(np.searchsorted(ends, starts, "right"), [*whole])
            starts, stops = starts[here], stops[here]
        ids, count = self.table.ids(data, starts, stops)
        self.whole = SLICES_WHOLE if 2 * self.table.new > len(starts) else 0
        before = np.r_[0, np.cumsum(count, dtype=np.int64)]
        out = np.split(ids, before[np.searchsorted(starts, ends[:-1])])
        for k in whole:
            out[k] = self.encode(texts[k].decode("utf-8"))
        return out


@lru_cache(maxsize=4)
def word_encoder(name: str) -> WordEncoder:
    return WordEncoder(vocabulary_path(name))


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str = BYTE_VOCABULARY, end_id: int = END_ID, shard_ids: int = SHARD_IDS
) -> None:
    """Writes the ids of every whole text, each followed by ``end_id``, in ascending ``doc_id`` order.

    A null or empty text is the end id alone. Rows with the same ``doc_id``
    stay apart, ordered by text; rows without one come first.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(vocabulary)
        end = np.array([end_id], "<u4")
        terminals = max(encoder.size, end_id + 1)
        first = TaskContext.get().partitionId() << RANGE_BITS
        keys: list = []
        ids: list = []
        held = 0

        def row() -> pa.RecordBatch:
            nonlocal first, keys, ids, held
            payload = repair.to_bytes(repair.compress(ids, terminals))
            values = [[first], [len(ids)], [held], [keys], [payload]]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            first, keys, ids, held = first + 1, [], [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(values, types, strict=True)],
                names=["shard", "n_docs", "n_ids", "doc_ids", "payload"],
            )

        for batch in batches:
            texts = batch.column(1).to_pylist()
            for key, one in zip(batch.column(0).to_pylist(), encoder.encode_all(texts), strict=True):
                keys.append(key)
                ids.append(np.concatenate([one, end]))
                held += len(one) + 1
                if held >= shard_ids:
                    yield row()
        if ids:
            yield row()

    ordered = doc_texts(docs).repartitionByRange("doc_id", F.xxhash64("text"))
    # equal ids are ordered by their whole texts within a range of one hash
    ordered = ordered.sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    ordered.mapInArrow(shards, SHARD_SCHEMA).write.parquet(path)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """For each shard the number of ids in all shards before it.

    Sums within each written range run side by side; only one row for each
    range meets in the running total over all.
    """
    sizes = spark.read.schema(SHARD_SCHEMA).parquet(path).select("shard", "n_ids")
    sizes = sizes.withColumn("range", F.shiftright("shard", RANGE_BITS))
    before = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = sizes.withColumn("own", before(Window.partitionBy("range").orderBy("shard")))
    ranges = sizes.groupBy("range").agg(F.sum("n_ids").alias("n_ids"))
    ranges = ranges.select("range", before(Window.orderBy("range")).alias("range_start"))
    return own.join(ranges, "range").select("shard", (F.col("own") + F.col("range_start")).alias("shard_start"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document, from the files alone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                reader = repair.Reader(repair.from_bytes(batch.column(2)[i].as_py()))
                sizes = reader.sizes()
                starts = batch.column(3)[i].as_py() + np.cumsum(sizes) - sizes
                crc = [zlib.crc32(ids.astype("<u4", copy=False).data) for ids in reader.documents()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1)[i].values, pa.array(starts), pa.array(sizes), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    files = spark.read.schema(SHARD_SCHEMA).parquet(path).select("shard", "doc_ids", "payload")
    placed = files.join(shard_starts(spark, path), "shard").select("shard", "doc_ids", "payload", "shard_start")
    return placed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_digests(docs: DataFrame, vocabulary: str = BYTE_VOCABULARY) -> DataFrame:
    """Writes the files to the shared folder and reads them back."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "token-files")
    write_token_files(docs, path, vocabulary)
    return read_token_files(spark, path)
