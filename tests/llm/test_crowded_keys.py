"""Exact dedup where one passage stands in very many different texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tablewarden.llm import exact_dedup

LENGTH = 60


def _want(texts):
    data = [t.encode() for t in texts]
    counts = Counter(d[i : i + LENGTH] for d in data for i in range(len(d) - LENGTH + 1))
    for k, d in enumerate(data):
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - LENGTH + 1):
            if counts[d[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = True
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        spans = int((gone & ~np.r_[False, gone[:-1]]).sum())
        yield k, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), spans > 0


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(12)
    letters = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    passage, short = letters(400), letters(LENGTH - 2)
    out = []
    for _ in range(80):  # one edit each, somewhere in the passage
        at = rng.randrange(len(passage))
        out.append(letters(rng.randint(0, 30)) + passage[:at] + rng.choice("xyz") + passage[at + 1 :] + letters(rng.randint(0, 30)))
    out += [letters(20) + short + letters(20) for _ in range(80)]  # just too short, in many surroundings
    out += [rng.choice("abc") + short + rng.choice("abc") + letters(5) for _ in range(40)]
    out += ["ab" * n + letters(9) for n in range(20, 60)]  # runs of one period and many lengths
    return [*out, passage, "é" * 100]


@pytest.mark.parametrize("segments", [1, 3, 10**9])
def test_near_copies(spark, texts, monkeypatch, segments):
    monkeypatch.setattr(exact_dedup, "SEGMENTS_OF_KEY", segments)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = exact_dedup.exact_dedup_digests(docs, LENGTH, 30)
    assert sorted(map(tuple, found.collect())) == list(_want(texts))


def test_anchors_get_longer():
    assert exact_dedup.finer_anchors(400, 200) == (380, 399)
    assert exact_dedup.finer_anchors(60, 30) == (57, 59) and exact_dedup.finer_anchors(20, 19) == (19,)
