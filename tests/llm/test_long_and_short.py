"""Very long texts in the token counts, short items in the decontamination, and an exact vote beside the classifier's."""

import random
import time

import numpy as np
import pytest

from tablewarden.llm import classifier, decontaminate, token_counts
from tablewarden.llm.common import vocabulary_path


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    path = vocabulary_path(token_counts.PIECE_VOCABULARY)
    return token_counts.PieceCounter(path), sentencepiece.SentencePieceProcessor(model_file=path)


def test_long_words_are_counted_as_the_library_does(pieces, monkeypatch):
    own, library = pieces
    rng = random.Random(4)
    alphabets = ["ab", "abcdefghijklmnopqrstuvwxyz", "aé漢🙂\x00", "0123456789.,;-_=", "thein", "a"]
    texts = ["".join(rng.choices(rng.choice(alphabets), k=rng.choice([1, 7, 300, 3000]))) for _ in range(120)]
    texts += ["the" * 2000 + " the " + "ing" * 900, "x" * 5000 + "\n" + "y" * 2500]
    want = [len(library.encode(t)) for t in texts]
    assert own.count(texts) == want
    monkeypatch.setattr(token_counts, "LONG_WORD", 3)
    own.counts.clear()
    assert own.count(texts) == want
    assert all(len(w) <= 3 for w in own.counts if w not in own.long_words)


def test_long_words_take_about_as_long_as_they_are(pieces):
    own, _ = pieces
    rng = random.Random(5)
    word = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=400_000))
    start = time.process_time()
    assert own.count([word])[0] > 100_000
    assert time.process_time() - start < 30


def test_short_items_are_whole_words(spark):
    items = spark.createDataFrame([(1, "yes"), (2, "a-b"), (3, "Nine char"), (4, "!"), (None, "zebra")], "item_id long, text string")
    texts = ["yesterday", "well, YES!", "eyes yes", "yes", "cab", "a b", "xnine char", "nine chars", "see nine-char.", None, "", "a zebra", "zebras"]
    docs = spark.createDataFrame([*enumerate(texts), (None, "yes it is"), (1, "well, YES!")], "doc_id long, text string")
    found = sorted((str(r.doc_id), r.item_id, r.edits, r.end) for r in decontaminate.find_items(docs, items).collect())
    assert found == sorted(
        [("1", 1, 0, 8), ("1", 1, 0, 8), ("2", 1, 0, 8), ("3", 1, 0, 3), ("5", 2, 0, 3), ("8", 3, 0, 13), ("11", -1, 0, 7), ("None", 1, 0, 3)]
    )
    left = {r.doc_id for r in decontaminate.without_items(docs, items).collect()}
    assert left == {0, 4, 6, 7, 9, 10, 12}


def test_a_long_text_is_searched_whole(spark):
    rng = random.Random(6)
    words = lambda n: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(n))
    item = words(40)
    docs = spark.createDataFrame([(1, words(60_000) + " " + item.upper() + " end"), (2, words(60_000))], "doc_id long, text string")
    found = decontaminate.find_items(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.edits) for r in found] == [(1, 7, 0)]


def test_votes_against_exact_cosines(spark):
    rng = random.Random(8)
    words = ["stone", "River", "light,", "x7", "Wind.", "cloud", "###", "A", "of", "the"]
    text = lambda: " ".join(rng.choices(words, weights=[rng.random() for _ in words], k=rng.randint(3, 60)))
    rows = [(i, text()) for i in range(300)]
    labels = [(i, rng.randint(0, 1)) for i in range(0, 300, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    counts, known = classifier.labelled_sample(docs, table)
    model = classifier.fit_model(counts, known)
    basis, idf = model.basis.astype(np.float64), model.idf.astype(np.float64)

    def latent(x):
        w = np.log1p(x.astype(np.float64)) * idf
        z = (w / np.linalg.norm(w)) @ basis
        return z / np.linalg.norm(z)

    voters = np.array([latent(c) for c in counts])
    got = {r.doc_id: r.score for r in classifier.classify(docs.repartition(5), table).collect()}
    for doc_id, t in rows:
        cosine = voters @ latent(classifier.term_counts(t))
        near = sorted(range(len(cosine)), key=lambda k: -cosine[k])
        cut = cosine[near[classifier.NEIGHBOURS - 1]]
        if abs(cut - cosine[near[classifier.NEIGHBOURS]]) < 1e-5:
            continue  # which of two equal ones votes is not stated
        chosen = near[: classifier.NEIGHBOURS]
        weight = np.clip(cosine[chosen], 0, None) ** 4
        want = float((weight * known[chosen]).sum() / weight.sum())
        assert abs(got[doc_id] - want) < 1e-3
    again = {r.doc_id: r.score for r in classifier.classify(docs.repartition(1), table).collect()}
    assert all(abs(got[k] - again[k]) < 1e-6 for k in got)
