"""Exact dedup where a key has many segments: work and rows stay in proportion to them."""

import random
from collections import defaultdict

import numpy as np
import pytest

from tablewarden.llm import exact_dedup, suffix_sort
from tests.llm.test_crowded_keys import LENGTH, _want, texts  # noqa: F401


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def test_crowded_key_that_fits_is_one_shard(spark, texts, monkeypatch):  # noqa: F811
    """No segment is cut into finer runs while its key fits a shard."""
    monkeypatch.setattr(exact_dedup, "SEGMENTS_OF_KEY", 3)
    monkeypatch.setattr(exact_dedup, "_cut_again", lambda *_: pytest.fail("cut again"))
    found = exact_dedup.exact_dedup_digests(_docs(spark, texts), LENGTH, 30)
    assert sorted(map(tuple, found.collect())) == list(_want(texts))


def test_key_larger_than_a_shard(spark, texts, monkeypatch):  # noqa: F811
    monkeypatch.setattr(exact_dedup, "SEGMENTS_OF_KEY", 3)
    cuts, cut = [], exact_dedup._cut_again
    monkeypatch.setattr(exact_dedup, "_cut_again", lambda *a: cuts.append(a[2]) or cut(*a))
    found = exact_dedup.exact_dedup_digests(_docs(spark, texts), LENGTH, 30, 3000)
    assert sorted(map(tuple, found.collect())) == list(_want(texts))
    assert cuts[0] == (45, 53, 57, 59) and len(cuts) > 1


def test_a_cut_makes_few_rows():
    assert exact_dedup.longer_anchors(400, 200) == (300, 350, 380, 399)
    assert exact_dedup.longer_anchors(20, 19) == (19,)
    rng = random.Random(4)
    text = bytes(rng.choices(b"abcdefgh ", k=2000))
    keys = defaultdict(set)
    for _ in range(300):
        copy = bytearray(text)
        for _ in range(4):
            copy[rng.randrange(len(copy))] = rng.choice(b"xyz")
        for key, first, last in zip(*[v.tolist() for v in exact_dedup.runs_of(bytes(copy))[:3]], strict=True):
            keys[key].add(bytes(copy[first : last + 400]))
    segments = [s for some in keys.values() if len(some) > 50 for s in some]
    rows = sum(len(exact_dedup.runs_of(s, 400, exact_dedup.longer_anchors(400, 200)[0])[0]) for s in segments)
    assert len(segments) > 500 and rows < 5 * len(segments)


def test_queues_are_scanned_whole():
    """A scan takes a few batches for each character, not one for each batch that filled its queue."""
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(300)]
    text = " ".join(rng.choices(words, k=4000)).encode()
    text = np.r_[np.frombuffer(text, np.uint8).astype(np.uint16), np.uint16(0)]
    batches = list(suffix_sort.descending_suffixes(text, 50))
    assert len(batches) <= 5 * len(set(text.tolist()))
    order = np.concatenate([place for place, _ in batches]).tolist()
    data = text.astype(np.uint8).tobytes()
    assert order == sorted(range(len(data)), key=lambda i: data[i:], reverse=True)


def test_order_of_names():
    rng = random.Random(2)
    for _ in range(200):
        names = rng.choices(range(1, rng.choice([2, 4, 50])), k=rng.randint(0, 40)) * rng.randint(1, 4) + [0]
        dense = np.unique(np.array(names), return_inverse=True)[1]
        want = sorted(range(len(names)), key=lambda i: names[i:])
        assert suffix_sort._order_of_names(dense.astype(np.int64)).tolist() == want
