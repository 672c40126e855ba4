"""What a worker keeps between batches is bounded in bytes, and so is a batch."""

import os
import random

from tablewarden.llm import bpe, classifier
from tablewarden.llm.common import BATCH_BYTES, Known, by_slices, ship_package


def _rss():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 1e6


def test_known_keeps_frequent_keys_and_few_bytes():
    asked = []
    known = Known(lambda k: asked.append(k) or k.encode() * 2, 20_000)
    for i in range(5000):
        assert known[f"rare {i}"] == f"rare {i}".encode() * 2 and known["often"] == b"oftenoften"
    assert asked.count("often") == 1 and len(known) + len(known._old) < 20_000 / Known.ENTRY_BYTES + 2
    long = "x" * 1_000_000
    assert known[long] and known[long] and asked.count(long) == 2 and long not in known


def test_caches_of_a_worker_are_bounded():
    rng = random.Random(1)
    words = bpe.word_bpe(bpe.WORD_VOCABULARY)

    def work(n):
        for _ in range(n):
            text = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 12))) for _ in range(2000))
            words.encode(text)
            classifier.term_counts(text)

    work(500)  # more words than are kept
    before = _rss()
    work(150)
    assert _rss() - before < 60
    held = sum(len(k[0] if isinstance(k, tuple) else k) + len(v) + Known.ENTRY_BYTES for c in (words.words, words.fragments) for k, v in c.items())
    assert held < bpe.WORD_BYTES + bpe.FRAGMENT_BYTES


def test_batches_are_bounded_in_bytes(spark):
    ship_package(spark.range(1))
    rows = spark.range(400).selectExpr("repeat('x', 200000) as text").coalesce(1)
    sizes = rows.mapInArrow(by_slices(lambda b: _size_of(b)), "n long").collect()
    assert sum(r.n for r in sizes) == 400 * 200000 and max(r.n for r in sizes) <= BATCH_BYTES + 400_000


def _size_of(batch):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([sum(len(t.as_py()) for t in batch.column(0))], pa.int64())], names=["n"])
