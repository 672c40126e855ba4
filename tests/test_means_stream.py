"""Moving means of arriving bars against the means of all bars, and which rows a late bar touches."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest

from tablewarden.operators.ordered import moving_means
from tablewarden.streaming.means_stream import ROW, MeansStore, start

SPANS = {"m3": 3, "m7": 7}


def _bar(rng, symbol, k):
    return symbol, date(2013, 1, 1) + timedelta(days=k), Decimal(rng.randint(1, 9999)) / 100


def _rows(df):
    return sorted(str(r) for r in df.select("symbol", "trade_date", "close_price", *SPANS).collect())


@pytest.mark.parametrize("rows_per_task", [10_000, 25])
def test_means_after_each_batch(spark, tmp_path, rows_per_task):
    rng = random.Random(5)
    store, held = MeansStore(spark, str(tmp_path / "s"), SPANS, rows_per_task), {}
    batches = [
        [_bar(rng, s, k) for s in ("A", "B", "HOT") for k in range(0, 120, 3)],
        [_bar(rng, "A", k) for k in range(120, 150)] + [_bar(rng, "HOT", k) for k in (31, 34, 70, 119, 200)],
        [_bar(rng, "B", k) for k in (-5, 1)] + [_bar(rng, "NEW", 4), _bar(rng, "HOT", 30)],  # 30 is there already
        [_bar(rng, s, k) for s in ("A", "B", "NEW") for k in range(130, 160, 2)] + [_bar(rng, "A", 131)] * 2,
    ]
    for n, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, ROW)
        store.apply(frame, n)
        for symbol, day, close in rows:
            old = held.get((symbol, day))
            held[symbol, day] = (n, close if old is None or old[0] < n else max(old[1], close))
        now = spark.createDataFrame([(s, d, c) for (s, d), (_, c) in held.items()], ROW)
        assert _rows(store.means()) == _rows(moving_means(now, SPANS))
        if n == 2:
            store.apply(frame, n)  # again, after a failure
            assert _rows(store.means()) == _rows(moving_means(now, SPANS))


def test_only_touched_rows_are_written(spark, tmp_path):
    rng = random.Random(6)
    store = MeansStore(spark, str(tmp_path / "s"), SPANS)
    store.apply(spark.createDataFrame([_bar(rng, s, 2 * k) for s in "AB" for k in range(100)], ROW), 0)
    store.apply(spark.createDataFrame([_bar(rng, "A", 51), _bar(rng, "B", 300)], ROW), 1)
    written = spark.read.parquet(str(tmp_path / "s" / "means" / "batch=1")).collect()
    # the late bar and six rows behind it; the new bar alone
    assert sorted((r.symbol, (r.trade_date - date(2013, 1, 1)).days) for r in written) == [
        ("A", 51), *[("A", k) for k in range(52, 64, 2)], ("B", 300)
    ]
    assert spark.read.parquet(str(tmp_path / "s" / "tails" / "batch=1")).count() == 12


def test_refused_and_empty_batches(spark, tmp_path):
    store = MeansStore(spark, str(tmp_path / "s"), SPANS)
    assert store.means().count() == 0
    store.apply(spark.createDataFrame([], ROW), 0)
    with pytest.raises(Exception, match="without a symbol or a day"):
        store.apply(spark.createDataFrame([("A", None, Decimal(1))], ROW), 1)
    assert store.means().count() == 0
    store.apply(spark.createDataFrame([("A", date(2013, 1, 1), None)], ROW), 1)
    assert [r.m3 for r in store.means().collect()] == [None]


def test_stream(spark, tmp_path):
    rng = random.Random(7)
    rows = [_bar(rng, s, k) for s in "AB" for k in rng.sample(range(90), 60)]
    store = MeansStore(spark, str(tmp_path / "s"), SPANS)
    for i in range(3):
        spark.createDataFrame(rows[i::3], ROW).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(ROW).parquet(str(tmp_path / "in"))
        start(stream, store, str(tmp_path / "check")).awaitTermination(120)
    assert _rows(store.means()) == _rows(moving_means(spark.createDataFrame(rows, ROW), SPANS))
