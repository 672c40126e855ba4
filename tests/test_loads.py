"""Serial numbers without gaps, and loads that may break off and be repeated."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from tablewarden.operators import serials
from tablewarden.schemas import BOOKING_COLUMNS
from tablewarden.sources import bookings
from tablewarden.sources.loads import Conflict, Load, LoadStore, load_bookings
from tests.test_ingest import GOOD


@pytest.mark.parametrize("parts", [1, 5])
def test_serials_follow_the_order(spark, parts):
    rows = [(None if i % 11 == 0 else i * 7919 % 100, str(i)) for i in range(500)]
    got = serials.with_serial(spark.createDataFrame(rows, "a int, b string").repartition(parts), ["a"], "n", 10).collect()
    assert sorted(r.n for r in got) == list(range(10, 510)) and sorted((r.a, r.b) for r in got if r.a is not None)
    by_number = [r.a for r in sorted(got, key=lambda r: r.n)]
    assert by_number == sorted((r[0] for r in rows), key=lambda a: (a is not None, a))


def test_equal_rows_are_cut_into_ranges(spark):
    rows = spark.range(20000).selectExpr("1 as a", "'x' as b").repartition(6)
    joins = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(joins, False)  # small ranges would be joined
    try:
        sizes = [n for n in serials.in_ranges(rows, ["a"]).rdd.glom().map(len).collect() if n]
    finally:
        spark.conf.set(joins, True)
    assert len(sizes) > 1 and max(sizes) < 15000
    got = serials.with_serial(rows, ["a"])
    assert sorted(r.id for r in got.collect()) == list(range(20000))
    plan = got._jdf.queryExecution().toString()
    assert "Window" not in plan and "row_number" not in plan


def test_serials_of_nothing(spark):
    got = serials.with_serial(spark.createDataFrame([], "a int"), ["a"])
    assert got.columns == ["a", "id"] and got.collect() == []


def _rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def _held(store):
    return [(r.id, r.load, r.v) for r in sorted(store.read().collect(), key=lambda r: r.id)]


def test_only_finished_loads_are_seen(spark, tmp_path):
    store = LoadStore(spark, str(tmp_path / "store"))
    assert store.finished() == []
    with pytest.raises(FileNotFoundError):
        store.read()
    assert store.run("a", _rows(spark, "a2", "a1", None), ["v"]) == store.finished()[0]
    # an attempt that broke off before it was published
    store.write("b", _rows(spark, "b1"))
    assert _held(store) == [(0, "a", None), (1, "a", "a1"), (2, "a", "a2")]
    store.run("b", _rows(spark, "b1", "b2"), ["v"])
    # a repeated load is the same load
    again = store.run("a", _rows(spark, "other"))
    assert (again.first_id, again.rows) == (0, 3)
    store.run("c", _rows(spark))
    store.run("d", _rows(spark, "d1"))
    assert _held(store)[3:] == [(3, "b", "b1"), (4, "b", "b2"), (5, "d", "d1")]
    assert [(x.load, x.first_id, x.rows) for x in store.finished()] == [("a", 0, 3), ("b", 3, 2), ("c", 5, 0), ("d", 5, 1)]


def test_a_load_is_replaced_as_a_whole(spark, tmp_path):
    store = LoadStore(spark, str(tmp_path / "store"))
    for name in "ab":
        store.run(name, _rows(spark, name + "1", name + "2"), ["v"])
    store.run("a", _rows(spark, "x1", "x2"), ["v"], replaces=True)
    assert _held(store) == [(0, "a", "x1"), (1, "a", "x2"), (2, "b", "b1"), (3, "b", "b2")]
    # another number of rows: new ids, the old ones are not used again
    store.run("a", _rows(spark, "y1", "y2", "y3"), ["v"], replaces=True)
    assert _held(store) == [(2, "b", "b1"), (3, "b", "b2"), (4, "a", "y1"), (5, "a", "y2"), (6, "a", "y3")]
    with pytest.raises(ValueError, match="columns differ"):
        store.run("c", spark.range(1))
    with pytest.raises(ValueError, match="name"):
        store.run("../c", _rows(spark, "c"))
    # the attempts of a's first two versions and the one with other columns
    assert store.forget_unfinished(older_than_hours=1) == 0
    assert store.forget_unfinished(older_than_hours=0) == 3
    assert len(_held(store)) == 5


def test_two_writers_do_not_lose_a_load(spark, tmp_path):
    store = LoadStore(spark, str(tmp_path / "store"))
    store.run("first", _rows(spark, "f"))
    version, loads, schema = store._version()
    store._publish(version + 1, [*loads, Load("x", "-", 1, 0)], schema)
    with pytest.raises(Conflict):
        store._publish(version + 1, loads, schema)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: store.run(f"l{n}", _rows(spark, f"v{n}", f"w{n}"), ["v"]), range(4)))
    ids = sorted((x.first_id, x.rows) for x in store.finished() if x.load != "x")
    assert ids == [(0, 1), (1, 2), (3, 2), (5, 2), (7, 2)]


def test_booking_files_keep_the_order_of_their_lines(spark, tmp_path):
    header = ",".join(BOOKING_COLUMNS)
    for name, numbers in (("2.csv", range(300, 500)), ("1.csv", range(300))):
        lines = [",".join({**GOOD, "lead_time": "x" if n % 50 == 7 else str(n)}.values()) for n in numbers]
        (tmp_path / name).write_text("\n".join([header, *lines]) + "\n")
    store = LoadStore(spark, str(tmp_path / "store"))
    for _ in range(2):
        done = load_bookings(store, "one", str(tmp_path / "*.csv"))
    assert (done.first_id, done.rows) == (0, 500)
    got = sorted(store.read().collect(), key=lambda r: r.id)
    assert [r.id for r in got] == list(range(500))
    assert [r.lead_time for r in got] == [None if n % 50 == 7 else n for n in range(500)]
    assert sum(r.reason is not None for r in got) == 10
    with pytest.raises(ValueError):
        bookings.read_strings(spark, str(tmp_path / "1.csv"), multi_line=True, in_order=True)
