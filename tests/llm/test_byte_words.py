"""Words of byte-level vocabularies cut for many texts at once, against the tokenizers library."""

import random

import numpy as np
import pytest

from tablewarden.llm import byte_words, token_files

PARTS = (
    ["'", "'s", "'re", "'ll", "'ve", "'t", "'m", "'d", "'R", "s", "re", "l", "ve", "a", "Zebra", "é", "ß", "жук", "字", "ǅ", "ʰ"]
    + ["0", "17", "²", "٣", "Ⅷ", "!", "...", "_", "\u0301", "€", "\u200d", "\ufeff", "\u180e", "\0", "\u0378", "😀", "𝒳", "ꟊ", "ჼ"]
    + [" ", " ", " ", "  ", "\n", "\r\n", "\t", "\u00a0", "\u2003", "\u3000", "\x85", "\x1c", "\u2028", "<s>", "</s>", "<|endoftext|>"]
)


@pytest.fixture
def encoder():
    return token_files.WordEncoder(token_files.vocabulary_path(token_files.BYTE_VOCABULARY))


def _check(encoder, texts):
    found = [ids.tolist() for ids in encoder.encode_all(texts)]
    assert found == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_texts_of_all_kinds(encoder, monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 12))) for _ in range(6000)]
    plain = PARTS[:11] + PARTS[40:48] + ["é", "Zebra"]
    texts += ["".join(rng.choices(plain, k=rng.randint(0, 12))) for _ in range(6000)]
    texts += ["", " ", "x" * 5000, " " * 5000 + "x", "é" * 700, "don't 'tis we'll've"]
    _check(encoder, texts)
    monkeypatch.setattr(token_files, "SLICE_BYTES", 40)
    monkeypatch.setattr(token_files, "SLICES_WHOLE", 0)
    _check(encoder, texts[:300] + texts[-6:])


def test_few_slots_and_ids(encoder, monkeypatch):
    monkeypatch.setattr(byte_words, "SLOT_BITS", 3)
    monkeypatch.setattr(byte_words, "POOL_IDS", 30)
    monkeypatch.setattr(token_files, "SLICE_BYTES", 60)
    monkeypatch.setattr(token_files, "SLICES_WHOLE", 0)
    encoder.table._clear()
    rng = random.Random(5)
    _check(encoder, ["".join(rng.choices([*PARTS, " word", " other"], k=9)) for _ in range(400)])


def test_a_known_word_is_not_encoded_again(encoder):
    asked = []
    one = encoder.table.encode
    encoder.table.encode = lambda word: asked.append(word) or one(word)
    texts = [f"the same words again and again, {k % 7}" for k in range(500)]
    for _ in range(2):
        _check(encoder, texts)
    assert len(asked) < 30


def test_slices_of_new_words_go_to_the_library(encoder, monkeypatch):
    asked = []
    one = encoder.table.encode
    encoder.table.encode = lambda word: asked.append(word) or one(word)
    monkeypatch.setattr(token_files, "SLICE_BYTES", 200)
    _check(encoder, [" ".join(f"w{k}x{j}" for j in range(20)) for k in range(1000, 1400)])
    assert len(asked) < 400 * 20 * 4 / token_files.SLICES_WHOLE


def test_unknown_classes_are_few():
    kinds = byte_words.classes()
    assert np.all(kinds[:0x21B] != byte_words.UNKNOWN) and np.all(kinds[0x4E00:0x9FA5] == byte_words.LETTER)
