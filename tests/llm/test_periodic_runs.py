"""Periodic runs against a search that tries every period, on odd rows and made words."""

import hashlib
import random
import re
import zlib

import pytest

from tablewarden.llm import periodic_runs as pr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs_by_period(words, least=12):
    """Every run: for each period the stretches in which words that far apart are equal."""
    found = []
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, 2 * q):
                shorter = any(all(words[i + k] == words[i + k + p] for k in range(size - p)) for p in range(1, q))
                if not shorter:
                    found.append((i, size, q))
            i = max(j, i + 1)
    return sorted(found)


def made(doc_id, words):
    if doc_id is None or not words:
        return words
    crc = zlib.crc32(str(doc_id).encode())
    if crc % 10:
        return words
    n, g = len(words), crc // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def digests(doc_id, text):
    words = made(doc_id, WORD.findall(text or ""))
    runs = runs_by_period(words)
    kept = [True] * len(words)
    for start, length, period in runs:
        kept[start + period : start + length] = [False] * (length - period)
    best = min(((-n, s, q) for s, n, q in runs), default=None)
    longest = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    left = " ".join(w for w, k in zip(words, kept, strict=True) if k)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, left)]
    return (doc_id, len(runs), *longest, *sha, len(words))


def test_runs_of_small_alphabets():
    rng = random.Random(1)
    for _ in range(1500):
        n, k = rng.randint(0, 60), rng.choice([1, 2, 2, 3])
        words = [rng.randrange(k) for _ in range(n)]
        if rng.random() < 0.5 and n:
            a, p = rng.randrange(n), rng.randint(1, 12)
            words = [words[i] if i < a else words[min(a + (i - a) % p, n - 1)] for i in range(n)]
        for least in (12, 5, 4, 2):
            assert pr.find_runs(words, least) == runs_by_period(words, least)


def test_long_periodic_texts_take_few_steps():
    assert pr.find_runs([0] * 200_000) == [(0, 200_000, 1)]
    assert pr.find_runs([i % 1000 for i in range(100_000)]) == [(0, 100_000, 1000)]
    with pytest.raises(ValueError):
        pr.periodic_runs(None, 1)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = lambda n, k: [f"w{rng.randrange(k)}" for _ in range(n)]
    texts = [None, "", " \t\n ", "one", "a " * 12, "a " * 11, "ab\x0bab\x0c" * 9, "x\x85y z " * 8, "\x00 é 漢字 " * 20]
    for _ in range(120):
        ws = words(rng.randint(1, 150), rng.choice([2, 3, 30, 400]))
        if rng.random() < 0.5:
            part = words(rng.randint(1, 20), 50) * rng.randint(2, 9)
            ws = ws[:30] + part[: rng.randint(1, len(part))] + ws[30:]
        texts.append(rng.choice([" ", "\n", " \t "]).join(ws))
    texts.append(" ".join(words(3000, 2000) * 2))
    out = [(i, t, 0.5, "no", [i]) for i, t in enumerate(texts)]
    return [*out, out[12], out[12], (None, texts[20], None, None, None), (None, None, None, None, None), (7, texts[30], None, None, None)]


def test_digests(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, start double, hash string, runs array<int>")
    expected = sorted((digests(r[0], r[1]) for r in rows), key=str)
    assert sum(r[1] for r in expected) > 60
    for parts in (1, 5):
        assert sorted(map(tuple, pr.run_digests(docs.repartition(parts)).collect()), key=str) == expected
    assert pr.run_digests(docs.limit(0)).collect() == []


def test_runs_end_where_documents_end(spark):
    docs = spark.createDataFrame([(1, "b a a a a a a"), (2, "a a a a a a c"), (3, "q " + "a b " * 6 + "a d")], "doc_id long, text string")
    found = {r.doc_id: r for r in pr.periodic_runs(docs.coalesce(1)).collect()}
    assert [len(found[i].runs) for i in (1, 2, 3)] == [0, 0, 1]
    assert tuple(found[3].runs[0]) == (1, 13, 2) and found[3].collapsed == "q a b d"
