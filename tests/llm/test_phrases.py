"""Collocations against plain counting of every phrase, with odd rows."""

import random
import re
from collections import Counter

import pytest

from tablewarden.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        words = re.findall(r"[^\x20\x09]+", piece)
        if words:
            yield words


def expected(rows, least=10, most=2000):
    counts = {}
    for lang, text in rows:
        count = counts.setdefault("und" if lang is None else lang, Counter())
        for words in pieces(text):
            for k in (1, 2, 3):
                count.update(zip(*(words[i:] for i in range(k)), strict=False))
    out = []
    for lang, f in counts.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        longer = Counter()
        for p, v in f.items():
            if len(p) == 3 and v >= least:
                for part in (p[:2], p[1:]):
                    longer[part] = max(longer[part], v)
        found = []
        for p, a in f.items():
            if len(p) > 1 and a >= least and not (len(p) == 2 and 100 * longer[p] >= 50 * a and longer[p]):
                cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    fixed = "This license is granted, free of charge to any person who obtains one copy of the work and its files"
    words = ["the", "The", "of", "stone", "river", "é", "漢字", "x\x00y", "light", "wind", "a\x85b", "🙂", "."]

    def text():
        out = [rng.choice(words) for _ in range(rng.randint(0, 80))]
        if rng.random() < 0.4:
            out.insert(rng.randint(0, len(out)), rng.choice([fixed, "New York City", "San Jose", "over and over and over and over"]))
        return rng.choice([" ", "  ", " \t"]).join(out).replace(" wind", rng.choice([" wind", "! wind", "\nwind", "\x0b"]))

    langs = ["en", "en", "en", "de", None, "", "x\ny"]
    out = [(i, text(), rng.choice(langs), 7, "q") for i in range(400)]
    odd = [None, "", " \t\n", ".", "one", "a b", "a b. c d e; f", "the " * 5000, "tie one\n" * 10 + "one tie\n" * 10]
    out += [(1000 + i, t, rng.choice(langs), None, None) for i, t in enumerate(odd)]
    return [*out, out[3], out[3], (None, "of the stone " * 12, None, None, None), (None, None, None, None, None)]


def test_collocations(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, path long, node string")
    want = expected([(r[2], r[1]) for r in rows])
    assert {r[0] for r in want} >= {"en", "de", "und", "", "x\ny"} and len(want) > 150
    for parts in (1, 4):
        assert sorted(map(tuple, phrases.collocations(docs.repartition(parts)).collect())) == want
    few = sorted(map(tuple, phrases.collocations(docs, most=3).collect()))
    assert few == [r for r in want if r[1] <= 3]
    assert phrases.collocations(docs.limit(0)).collect() == []
    assert phrases.collocations(docs.where("text = ''")).collect() == []


def test_sums_do_not_depend_on_chunks(rows):
    texts = [r[1] or "" for r in rows if r[2] == "en"]
    want = Counter()
    for t in texts:
        for words in pieces(t):
            want[b""] += len(words)
            for k in (1, 2, 3):
                want.update(" ".join(p).encode() for p in zip(*(words[i:] for i in range(k)), strict=False))
    for size in (7, 1000, 1 << 20):
        got = Counter()
        old, phrases.CHUNK_WORDS = phrases.CHUNK_WORDS, size
        try:
            for _, *packed in phrases._packed("en", texts, 5):
                sums = phrases._bucket_sums([tuple(packed)], 1)
                for r in sums.to_pylist():
                    got[" ".join(r["words"]).encode()] += r["n"]
        finally:
            phrases.CHUNK_WORDS = old
        assert got == want


def test_counts_beyond_64_bits_are_exact(spark):
    a, left, right = 3_000_000_019, 3_000_000_021, 9_000_000_011
    rows = [("en", [], 10**12), ("en", ["p"], left), ("en", ["q"], right), ("en", ["p", "q"], a)]
    counts = spark.createDataFrame(rows, phrases.COUNTS)
    found = phrases.scored(counts).collect()
    assert [tuple(r) for r in found] == [("en", 1, "p q", a, left, right, 10**12, 10**6 * a * a // (left * right))]


def test_paths(spark):
    fixed = "this license is granted free of charge to any person who obtains one copy of the work"
    text = "\n".join([fixed] * 12 + ["a person who obtains much"] * 10 + ["x y z"] * 15 + ["u v"] * 30)
    docs = spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")
    found = {(r.phrase, r.n_words, r.n) for r in phrases.fixed_phrases(docs).collect()}
    assert found == {
        ("this license is granted free of charge to any person who", 11, 12),
        ("any person who obtains"[4:], 3, 22),
        ("who obtains one copy of the work", 7, 12),
        ("a person who", 3, 10),
        ("who obtains much", 3, 10),
        ("x y z", 3, 15),
    }
    counts = phrases.phrase_counts(docs)
    assert {r.phrase for r in phrases.candidates(counts).collect() if r.phrase.count(" ") == 1} == {"u v"}
