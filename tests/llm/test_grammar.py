"""Re-Pair to the end: no frequent pair is left, copies become a few symbols, and deep rules give any document."""

import random
from collections import Counter

import numpy as np
import pytest

from tablewarden.llm import repair, token_files
from tablewarden.llm.common import vocabulary_path


def _left_over(g):
    """Counts of neighbours within documents, without overlaps."""
    counts = Counter()
    for i in range(len(g.ends)):
        symbols = g.symbols[(g.ends[i - 1] if i else 0) : g.ends[i]].tolist()
        end = {}
        for k, pair in enumerate(zip(symbols, symbols[1:], strict=False)):
            if end.get(pair, -1) < k:
                counts[pair] += 1
                end[pair] = k + 1
    return counts


@pytest.mark.parametrize("bits,least,most", [(18, 24, 4096), (18, 2, 3), (3, 4, 50), (1, 3, 4096)])
def test_no_frequent_pair_is_left(monkeypatch, bits, least, most):
    monkeypatch.setattr(repair, "_BUCKET_BITS", bits)
    monkeypatch.setattr(repair, "LEAST_COUNT", least)
    monkeypatch.setattr(repair, "RULES_PER_ROUND", most)
    rng = random.Random(bits + least)
    for _ in range(12):
        k = rng.choice([1, 2, 5, 40])
        docs = [np.array([rng.randrange(k) for _ in range(rng.choice([0, 1, 2, 50, 400]))], "<u4") for _ in range(rng.randint(0, 12))]
        docs += docs[: len(docs) // 2]
        g = repair.from_bytes(repair.to_bytes(repair.compress(docs, 50)))
        reader = repair.Reader(g)
        assert [d.tolist() for d in reader.documents()] == [d.tolist() for d in docs]
        for i in rng.sample(range(len(docs)), len(docs)):
            assert reader.document(i).tolist() == docs[i].tolist()
        assert not [p for p, n in _left_over(g).items() if n >= max(least, 2)]
        assert reader.sizes().tolist() == [len(d) for d in docs]


def test_copies_become_few_symbols():
    rng = np.random.default_rng(5)
    doc = rng.integers(3, 50_000, 2000).astype("<u4")
    g = repair.compress([doc] * 1000, 50_257)
    assert len(g.symbols) < 10_000 and g.lengths.max() > 400
    reader = repair.Reader(g)
    assert all((reader.document(i) == doc).all() for i in (0, 1, 500, 999))
    one = repair.compress([np.full(200_000, 7, "<u4")], 10)
    assert len(one.symbols) < 100 and (repair.Reader(one).document(0) == 7).all()


def test_words_are_encoded_as_the_library_does():
    from tokenizers import Tokenizer

    path = vocabulary_path(token_files.BYTE_VOCABULARY)
    library, own = Tokenizer.from_file(path), token_files.WordEncoder(path)
    rng = random.Random(3)
    bits = ["a", "word", "Word,", "\n", "\n\n", " ", "  ", "\t", "\r\n", "é", "漢字", "'s", "'ll", "12", "!", "...", "\x0b", " "]
    bits += ["<|endoftext|>", "\x00", "\x85", "x\ny", "end.\nNext", " ", "ﬁ", "🙂", "\x1c", "'"]
    for _ in range(6000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 12)))
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_very_long_words_and_white_space_are_encoded_as_the_library_does():
    from tokenizers import Tokenizer

    path = vocabulary_path(token_files.BYTE_VOCABULARY)
    library, own = Tokenizer.from_file(path), token_files.word_encoder(token_files.BYTE_VOCABULARY)
    for text in (" " * 400_000, "\n" * 200_000 + "x", " " * 200_000 + "x a", "a" * 300_000, "ab " + "\t" * 100_000 + " y", "!?" * 100_000):
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
