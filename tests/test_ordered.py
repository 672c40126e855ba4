"""Cut groups give the same as whole groups and as a plain loop."""

import random
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest

from tablewarden.operators.ordered import crowded_groups, moving_means, position_in_group, with_chunk
from tablewarden.operators.pairs import later_partners, pairs_in_group

SPANS = {"m3": 3, "m5": 5}


def _bars(seed=3, crowded=400, repeats=True):
    rng, rows = random.Random(seed), []
    for symbol, n in [("HOT", crowded), ("A", 4), ("B", 30), ("C", 1)]:
        for i in range(n):
            day = date(2015, 1, 1) + timedelta(days=i // 3 if repeats else i)
            rows.append((len(rows), symbol, day, Decimal(rng.randint(1, 10**6)) / 100))
    rng.shuffle(rows)
    return rows


def _loop(rows):
    out = {}
    for symbol in {r[1] for r in rows}:
        mine = sorted((r[2], r[0], r[3]) for r in rows if r[1] == symbol)
        for i, (_, key, _) in enumerate(mine):
            means = []
            for span in SPANS.values():
                part = [m[2] for m in mine[max(0, i - span + 1) : i + 1]]
                means.append((sum(part) / len(part)).quantize(Decimal("0.0001"), ROUND_HALF_UP))
            out[key] = tuple(means)
    return out


@pytest.mark.parametrize("rows_per_task", [10**6, 50, 7, 2])
@pytest.mark.parametrize("repeats", [True, False])
def test_moving_means(spark, rows_per_task, repeats):
    rows = _bars(repeats=repeats)
    df = spark.createDataFrame(rows, "id long, symbol string, trade_date date, close_price decimal(12,4)")
    got = moving_means(df, SPANS, ties=["id"], rows_per_task=rows_per_task)
    assert {r.id: (r.m3, r.m5) for r in got.collect()} == _loop(rows)
    assert got.count() == len(rows)


def test_crowded_groups_are_found_by_count(spark):
    df = spark.createDataFrame([("a", i) for i in range(10)] + [("b", 1)], "g string, i long")
    assert crowded_groups(df, ["g"], 10) is None
    assert [r.g for r in crowded_groups(df, ["g"], 9).collect()] == ["a"]


@pytest.mark.parametrize("rows_per_task", [10**6, 10, 1])
def test_positions_and_partners(spark, rows_per_task):
    rng = random.Random(9)
    ids = rng.sample(range(5000), 300)
    rows = [(rng.choice(["x", "x", "x", "y", None]), i) for i in ids]
    df = spark.createDataFrame(rows, "g string, id long")
    got = position_in_group(df.where("g is not null"), "g", "id", "place", rows_per_task).collect()
    for g in ("x", "y"):
        mine = sorted(i for h, i in rows if h == g)
        assert sorted((r.id, r.place) for r in got if r.g == g) == [(i, n) for n, i in enumerate(mine, 1)]
    down = position_in_group(df.where("g = 'x'"), "g", "id", "place", rows_per_task, descending=True)
    assert [r.id for r in down.orderBy("place").collect()] == sorted((i for h, i in rows if h == "x"), reverse=True)
    partners = {r.id: r.sonraki_uye for r in later_partners(df, "g", "id", rows_per_task).collect()}
    assert partners == {i: sum(1 for h, j in rows if h == g and j > i) for g, i in rows if g is not None}
    pairs = {r.g: r.cift_sayisi for r in pairs_in_group(df, "g", "id").collect()}
    for g in ("x", "y"):
        assert pairs[g] == sum(n for i, n in partners.items() if (g, i) in rows)


def _frame(spark, kind):
    """Crowded frames whose key, day or seq is missing, sparse or all the same."""
    rng = random.Random(4)
    rows = []
    for i in range(200):
        key = None if kind == "null key" and i % 2 else "HOT" if i < 160 else "A"
        day = None if kind == "null day" and i % 10 == 0 else date(2015, 1, 1) + timedelta(days=0 if kind == "one day" else i // 3)
        seq = None if kind == "null seq" and i % 10 == 0 else i * 10**6 if kind == "sparse" else i
        rows.append((i, key, day, seq, Decimal(rng.randint(1, 10**6)) / 100))
    return spark.createDataFrame(rows, "id long, symbol string, trade_date date, seq long, close_price decimal(12,4)")


KINDS = ["null key", "null day", "null seq", "sparse", "one day"]


@pytest.mark.parametrize("kind", KINDS)
def test_cut_groups_keep_every_row(spark, kind):
    df = _frame(spark, kind)
    means = [sorted(moving_means(df, SPANS, ties=["id"], rows_per_task=n).drop("_pos").collect(), key=str) for n in (10**6, 20)]
    assert len(means[1]) == 200 and means[0] == means[1]
    places = [position_in_group(df, "symbol", "seq", "place", n).select("symbol", "seq", "place").collect() for n in (10**6, 20)]
    assert len(places[1]) == 200 and sorted(places[0], key=str) == sorted(places[1], key=str)


@pytest.mark.parametrize("kind", KINDS)
def test_chunks_hold_counted_rows(spark, kind):
    rows, split = with_chunk(_frame(spark, kind), ["symbol"], ["trade_date", "seq"], 20)
    assert split
    sizes = {(r.symbol, r[1]): r[2] for r in rows.groupBy("symbol", "_chunk").count().collect()}
    assert max(n for (_, chunk), n in sizes.items() if chunk) <= 20
    assert sum(sizes.values()) == 200
