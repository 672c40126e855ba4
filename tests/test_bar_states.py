"""Reports from merged states against the same reports from bars."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest

from tablewarden.operators import profile
from tablewarden.operators.bar_states import StateStore
from tablewarden.plans import bars as B

BARS = (
    "symbol string, trade_date date, open_price decimal(12,4), high_price decimal(12,4), low_price decimal(12,4), "
    "close_price decimal(12,4), volume bigint"
)
SYMBOLS = ["A", "B", "C", "HOT"]


def _bars(rng, days, symbols=SYMBOLS, copies=1):
    out = []
    for symbol in symbols:
        for day in days:
            for _ in range(rng.randint(1, copies)):
                price = lambda: rng.choice([None, Decimal(rng.randint(1, 99999)) / 100])
                out.append((symbol, day, price(), price(), price(), price(), rng.choice([None, rng.randint(1, 10**9)])))
    return out


def _rows(df):
    return sorted(map(str, df.collect()))


def _compare(store, now):
    states = store.states()
    assert _rows(B.yearly_stats_of_states(states, SYMBOLS)) == _rows(B.yearly_stats(now, SYMBOLS))
    assert _rows(B.yearly_returns_of_states(states)) == _rows(B.yearly_returns(now))
    for equal in (False, True):
        of_states = B.mean_returns(B.yearly_returns_of_states(states), 1, equal_years=equal)
        assert _rows(of_states) == _rows(B.avg_yearly_return(now, 1, equal_years=equal))
    assert _rows(B.load_summary_of_states(states)) == _rows(B.load_summary(now))


def test_merged_states_equal_the_bars(spark, tmp_path):
    rng = random.Random(7)
    day = lambda k: date(2012, 12, 1) + timedelta(days=k)
    loads = [
        _bars(rng, [day(k) for k in range(0, 600, 3)], copies=2),
        _bars(rng, [day(k) for k in range(1, 900, 3)]),
        _bars(rng, [day(k) for k in (0, 3, 4, 30, 31, 400)], ["A", "HOT"]),  # corrects days of both
        _bars(rng, [day(k) for k in range(2, 1500, 3)], ["B", "NEW"]),
    ]
    store, current = StateStore(spark, str(tmp_path / "store")), {}
    with pytest.raises(FileNotFoundError):
        store.states()
    for n, rows in enumerate(loads):
        frame = spark.createDataFrame(rows, BARS)
        store.apply(frame, n)
        for key in {(r[0], r[1]) for r in rows}:
            current[key] = [r for r in rows if (r[0], r[1]) == key]
        now = spark.createDataFrame([r for rs in current.values() for r in rs], BARS)
        _compare(store, now)
        assert _rows(store.bars().select(*now.columns)) == _rows(now)
        if n == 2:
            store.apply(frame, n)  # again, after a failure
            _compare(store, now)
    store.compact(3)
    _compare(store, now)


def test_a_load_that_broke_off_is_not_seen(spark, tmp_path, monkeypatch):
    rng = random.Random(8)
    store = StateStore(spark, str(tmp_path / "store"))
    first = spark.createDataFrame(_bars(rng, [date(2013, 1, 2)]), BARS)
    store.apply(first, 0)
    with monkeypatch.context() as m:
        m.setattr(StateStore, "bars", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.apply(first, 1)
    _compare(store, first)
    with pytest.raises(Exception, match="without a symbol or a day"):
        store.apply(spark.createDataFrame([("A", None, None, None, None, None, None)], BARS), 1)
    store.apply(spark.createDataFrame([], BARS), 2)
    _compare(store, first)


def test_reports_read_states_and_not_bars(spark, tmp_path):
    rng = random.Random(9)
    store = StateStore(spark, str(tmp_path / "store"))
    for n in range(2):
        store.apply(spark.createDataFrame(_bars(rng, [date(2013, 1 + n, 1 + k) for k in range(20)]), BARS), n)
    steps = profile.run(B.yearly_stats_of_states(store.states(), SYMBOLS)).steps
    scans = [s for s in steps if s.operator == "Scan"]
    assert scans and all("/states" in s.detail or "InMemoryFileIndex" in s.detail for s in scans)
    # two changed states for each symbol, instead of forty bars
    assert sum(s.metrics["numOutputRows"] for s in scans) == 2 * len(SYMBOLS)
