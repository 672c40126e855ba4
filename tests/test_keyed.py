"""Constraints that act on a write: accepted rows, refused rows, repeated and broken batches."""

import random
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.operators import profile
from tablewarden.operators.keyed import KeyedTable, Reference
from tablewarden.sources import layout

PARENT = T.StructType([T.StructField("p", T.LongType()), T.StructField("q", T.StringType())])
ROWS = T.StructType(
    [T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("p", T.LongType()), T.StructField("v", T.IntegerType())]
)


@pytest.fixture()
def tables(spark, tmp_path):
    tag = uuid.uuid4().hex[:8]
    parent = KeyedTable(spark, str(tmp_path / "parent"), f"parent_{tag}", PARENT, ["p"], buckets=4)
    parent.append(spark.createDataFrame([(i, "x") for i in range(10)], PARENT), 0)
    rules = {"v: negative": F.col("v") < 0}
    make = lambda: KeyedTable(
        spark, str(tmp_path / "rows"), f"rows_{tag}", ROWS, ["a", "b"], [Reference(("p",), parent)], rules, buckets=4
    )
    yield make
    for name in (f"rows_{tag}_keys", f"parent_{tag}_keys"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def one_by_one(batches):
    """What inserting row by row, in order of v, gives."""
    held, accepted, refused = set(), [], []
    for n, rows in enumerate(batches):
        for a, b, p, v in sorted(rows, key=lambda r: (r[3] is not None, r[3] or 0)):
            reasons = [f"{name}: null in key" for name, x in (("a", a), ("b", b)) if x is None]
            reasons += ["v: negative"] if v is not None and v < 0 else []
            reasons += ["p: not in parent"] if p is not None and p > 9 else []
            if not reasons and (a, b) in held:
                reasons = ["a, b: key exists"]
            if reasons:
                refused.append((n, a, b, p, v, tuple(reasons)))
            else:
                held.add((a, b))
                accepted.append((n, a, b, p, v))
    return accepted, refused


def _found(table):
    accepted = [(r.batch, r.a, r.b, r.p, r.v) for r in table.accepted().collect()]
    refused = [
        (r.batch, r.a, r.b, r.p, r.v, tuple(x.replace(table.references[0].parent.name, "parent") for x in r.reasons))
        for r in table.refused().collect()
    ]
    return sorted(accepted, key=str), sorted(refused, key=str)


def test_batches_as_if_row_by_row(spark, tables):
    rng = random.Random(3)
    table = tables()
    batches, v = [], 0
    for _ in range(3):
        rows = []
        for _ in range(300):
            v += 1
            key = (1, "hot") if rng.random() < 0.4 else (rng.choice([None, *range(60)]), rng.choice([None, "x", "y"]))
            rows.append((*key, rng.choice([None, *range(12)]), -v if rng.random() < 0.1 else v))
        batches.append(rows)
    for n, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, ROWS).repartition(3)
        accepted, refused = table.append(frame, n, order=["v"])
        assert accepted + refused == 300
        if n == 1:  # a repeated batch gives the same rows
            before = _found(table)
            assert table.append(frame, n, order=["v"]) == (accepted, refused) and _found(table) == before
    want = one_by_one(batches)
    assert _found(table) == tuple(sorted(w, key=str) for w in want)
    assert table.stored_keys().count() == len(want[0]) == table.stored_keys().select("a", "b").distinct().count()
    # another session reads the same folders
    again = tables()
    assert _found(again) == _found(table) and again.stored_keys().count() == len(want[0])


def test_a_batch_that_broke_off_is_not_seen(spark, tables, monkeypatch):
    table = tables()
    table.append(spark.createDataFrame([(1, "x", 1, 1)], ROWS), 0)
    second = spark.createDataFrame([(1, "x", 1, 2), (2, "x", 1, 3), (3, "x", 99, 4)], ROWS)
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_drop_keys", lambda self, batch: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.append(second, 1)
    assert _found(table) == ([(0, 1, "x", 1, 1)], [])
    with pytest.raises(RuntimeError, match="batch 1"):
        table.append(second, 2)
    assert table.append(second, 1) == (1, 2)
    assert [r[1] for r in _found(table)[0]] == [1, 2] and table.batches().count() == 2


def test_empty_batches(spark, tables):
    table = tables()
    assert table.accepted().count() == table.refused().count() == 0
    assert table.append(spark.createDataFrame([], ROWS), 0) == (0, 0)
    assert table.append(spark.createDataFrame([(None, None, None, None)], ROWS), 1) == (0, 1)
    assert table.append(spark.createDataFrame([(1, "x", None, None)], ROWS), 2) == (1, 0)
    assert table.refused().first().reasons == ["a: null in key", "b: null in key"]


def test_stored_keys_are_not_shuffled(spark, tables):
    table = tables()
    table.append(spark.createDataFrame([(i, "x", 1, 1) for i in range(50)], ROWS), 0)
    rows = spark.createDataFrame([(i, "x", 1, 1) for i in range(90)], ROWS)
    firsts = rows.withColumn("_first", F.struct(F.monotonically_increasing_id().alias("_place")))
    for frame in (table.new_keys(firsts, 7), table.references[0].parent.missing(rows, ["p"])):
        steps = profile.run(frame).steps
        join = next(s for s in steps if s.operator == "SortMergeJoin")
        new, stored = [s for s in steps if s.parent == join.id]
        below = [s for s in steps if s.id >= stored.id]
        assert [s.operator for s in below if s.operator == "Scan"] == ["Scan"] and "Bucketed: true" in below[-1].detail
        assert not any("Exchange" in s.operator for s in below)
        assert any("Exchange" in s.operator for s in steps if new.id <= s.id < stored.id)


def test_days_without_a_partition_stop_the_write(spark, tmp_path):
    rows = lambda day: spark.sql(f"select {day} as trade_date, 'A' as symbol, 1 as v")
    layout.write_by_year(rows("date'2013-01-02'"), str(tmp_path / "a"), years=(2013, 2018))
    layout.write_by_year(rows("date'2030-01-02'"), str(tmp_path / "a"))
    assert layout.read_by_year(spark, str(tmp_path / "a")).count() == 2
    for day, years in (("cast(null as date)", None), ("date'2019-01-01'", (2013, 2018)), ("date'2012-12-31'", (2013, 2018))):
        with pytest.raises(Exception, match="no partition for day"):
            layout.write_by_year(rows(day), str(tmp_path / "b"), years=years)


def test_rows_without_a_contested_key_are_not_moved(spark, tables):
    table = tables()
    table.append(spark.createDataFrame([(0, "x", 1, 1)], ROWS), 0)
    rows = [(i, "x", i % 12 if i % 5 else None, i) for i in range(4000)] + [(7, "x", 1, 9000), (7, "x", 1, -1)]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8000")
    try:
        # as many distinct keys as rows; only what stands twice or is stored is joined
        checked = table.check(spark.createDataFrame(rows, ROWS), 1, ["v"])
        steps = profile.run(checked).steps
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert not any(s.operator in ("SortMergeJoin", "ShuffledHashJoin", "SortAggregate") for s in steps)
    reasons = {(r.a, r.v): [x.split(":")[1] for x in r.reasons] for r in checked.collect()}
    assert reasons[0, 0] == [" key exists"] and reasons[7, 7] == [] and reasons[7, 9000] == [" key exists"]
    assert reasons[7, -1] == [" negative"] and reasons[11, 11][0].startswith(" not in") and len(reasons) == 4002
