"""Byte-pair encoding with forced boundaries, and decoding.

A merge joins two neighbours into a token of the vocabulary. Two neighbouring
bytes that stand side by side in no token can therefore never end up in one
token: between them every encoding has a cut. A word is split at these certain
cuts, the fragments are encoded on their own, and the ids are put one after
the other.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tablewarden.llm.common import Known, by_slices, doc_texts, vocabulary_path

WORD_VOCABULARY = "word_bpe_49k.json"

#: Bytes of words and of fragments kept between batches.
WORD_BYTES, FRAGMENT_BYTES = 128 << 20, 32 << 20

#: From so many symbols on a fragment is merged with a heap.
HEAP_SYMBOLS = 48


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    spare = 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(spare)
            spare += 1
    return [letters[b] for b in range(256)]


def merge_all(symbols: list, ranks: dict) -> list:
    """Joins the pair of lowest rank, leftmost first, until none is left."""
    if len(symbols) >= HEAP_SYMBOLS:
        return _merge_with_heap(symbols, ranks)
    while len(symbols) > 1:
        best, at = None, 0
        for i in range(len(symbols) - 1):
            found = ranks.get((symbols[i], symbols[i + 1]))
            if found is not None and (best is None or found < best):
                best, at = found, i
        if best is None:
            break
        symbols[at : at + 2] = [best[1]]
    return symbols


def _merge_with_heap(symbols: list, ranks: dict) -> list:
    """The same in n log n, over a linked list."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    after[-1] = -1
    gone = bytearray(n)
    heap = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] >= 0:
            found = ranks.get((symbols[i], symbols[after[i]]))
            if found is not None:
                heapq.heappush(heap, (found[0], i, symbols[i], symbols[after[i]], found[1]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, left, right, merged = heapq.heappop(heap)
        j = after[i]
        if gone[i] or j < 0 or symbols[i] != left or symbols[j] != right:
            continue
        symbols[i] = merged
        gone[j] = 1
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        offer(before[i])
        offer(i)
    return [s for i, s in enumerate(symbols) if not gone[i]]


class WordBpe:
    """A word-level BPE with word ends, lower case and dropped white space."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*self.vocab.values(), *self.special.values()]))
        for token, i in [*self.vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.letters = byte_letters()
        self.ranks = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.ranks.setdefault((a, b), (rank, a + b))
        inside = set()
        at_end = set()
        for token in self.vocab:
            ends = token.endswith(self.end) and token != self.end
            body = token[: -len(self.end)] if ends else token
            pairs = list(zip(body, body[1:], strict=False))
            if ends and pairs:
                at_end.add(pairs.pop())
            inside.update(pairs)
        self.inside, self.at_end = inside, at_end
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.words = Known(self._encode_word, WORD_BYTES)
        self.fragments = Known(self._encode_fragment, FRAGMENT_BYTES)

    def _encode_fragment(self, key: tuple[str, bool]) -> bytes:
        body, last = key
        symbols = list(body)
        if last:
            symbols[-1] += self.end
        ids = [self.vocab[s] for s in merge_all(symbols, self.ranks)]
        return np.array(ids, "<u4").tobytes()

    def cut(self, word: str) -> list[str]:
        """The fragments of a word between its certain cuts, as byte letters."""
        body = "".join([self.letters[b] for b in word.encode("utf-8")])
        out, start, last = [], 0, len(body) - 1
        for i in range(last):
            pair = (body[i], body[i + 1])
            if pair not in (self.at_end if i + 1 == last else self.inside):
                out.append(body[start : i + 1])
                start = i + 1
        out.append(body[start:])
        return out

    def _encode_word(self, word: str) -> bytes:
        parts = self.cut(word)
        last = len(parts) - 1
        return b"".join([self.fragments[p, i == last] for i, p in enumerate(parts)])

    def normalise(self, text: str) -> str:
        # each character by itself: a sigma at the end of a word is no special case
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def encode(self, text: str) -> np.ndarray:
        parts = [text]
        if "<|" in text:
            parts = self.special_pattern.split(text)
        out = []
        for part in parts:
            if part in self.special:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            elif part:
                out.extend(map(self.words.__getitem__, self.pattern.findall(self.normalise(part))))
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids) -> str:
        """Tokens with blanks between them, as a tokenizer without a decoder gives them."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=4)
def word_bpe(name: str) -> WordBpe:
    return WordBpe(vocabulary_path(name))


def _id_lists(each: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(each) + 1, np.int32)
    np.cumsum([len(x) for x in each], out=offsets[1:])
    values = np.concatenate([*each, np.empty(0, "<u4")]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def encode_documents(docs: DataFrame, vocabulary: str = WORD_VOCABULARY) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every whole text.

    A null or empty text gives an empty array. Repeated rows stay repeated,
    other columns are left out.
    """

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = word_bpe(vocabulary)
        ids = _id_lists([bpe.encode(t) for t in batch.column(1).to_pylist()])
        return pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])

    return doc_texts(docs).mapInArrow(by_slices(encode), "doc_id long, ids array<int>")


def _round_trip(docs: DataFrame, vocabulary: str, with_ids: bool) -> DataFrame:
    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = word_bpe(vocabulary)
        each, n, of_ids, of_text = [], [], [], []
        for text in batch.column(1).to_pylist():
            ids = bpe.encode(text)
            if with_ids:
                each.append(ids)
            n.append(len(ids))
            of_ids.append(hashlib.sha256(ids.tobytes()).hexdigest())
            of_text.append(hashlib.sha256(bpe.decode(ids).encode("utf-8")).hexdigest())
        columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids), pa.array(of_text)]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            columns.append(_id_lists(each))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return doc_texts(docs).mapInArrow(by_slices(digest), schema + (", ids array<int>" if with_ids else ""))


def round_trip_digests(docs: DataFrame, vocabulary: str = WORD_VOCABULARY) -> DataFrame:
    """Count and digest of the ids of every text, and digest of what they decode to.

    Encoding and decoding run in one pass, so that no id leaves the worker. A
    null or empty text has no token. Repeated rows stay repeated.
    """
    return _round_trip(docs, vocabulary, with_ids=False)


def encoded_round_trip(docs: DataFrame, vocabulary: str = WORD_VOCABULARY) -> DataFrame:
    """The same with the ids themselves as a last column."""
    return _round_trip(docs, vocabulary, with_ids=True)
