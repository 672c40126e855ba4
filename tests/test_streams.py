import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from tablewarden.operators.audit import PriceGuard, audit_log
from tablewarden.sources import bars_csv
from tablewarden.streaming import bars_stream
from tablewarden.streaming.price_stream import CHANGE_SCHEMA, PriceStore, guard_stream, without_repeats

T0 = datetime(2024, 1, 1)
BASE = "rezervasyon_id long, hotel string, adr decimal(10,2)"


def _changes(n, seed=5):
    rng = random.Random(seed)
    roles = ["admin", "city_reception", "resort_reception", "nobody"]
    return [
        (i, T0 + timedelta(seconds=i), rng.choice(roles), rng.randint(0, 12), rng.choice([None, Decimal(rng.randint(1, 9))]))
        for i in range(n)
    ]


def _base(spark):
    rows = [(k, ["City Hotel", "Resort Hotel", None][k % 3], Decimal(k)) for k in range(12)]
    return spark.createDataFrame(rows, BASE)


def _rows(df, drop=("batch",)):
    return sorted(str(r) for r in df.drop(*drop).collect())


@pytest.mark.parametrize("broadcast_keys", [1000, 0])
def test_stream_equals_batch_with_replay_and_compaction(spark, tmp_path, broadcast_keys):
    rows = _changes(240)
    everything = spark.createDataFrame(rows, CHANGE_SCHEMA)
    guard, base = PriceGuard(), _base(spark)
    source = tmp_path / "in"
    for i in range(4):
        part = spark.createDataFrame(rows[i * 60 : (i + 1) * 60], CHANGE_SCHEMA)
        part.coalesce(1).write.mode("append").parquet(str(source))
    # one file per batch, in order of writing
    stream = spark.readStream.schema(CHANGE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(source))
    store = PriceStore(spark, str(tmp_path / "store"), broadcast_keys)
    store.start(base)
    guard_stream(stream, store, guard, str(tmp_path / "check"), compact_every=2).awaitTermination(180)
    plan = store.prices(keys=everything.select("rezervasyon_id"), buckets=[1])._jdf.queryExecution().toString()
    assert "PartitionFilters: [bucket" in plan or "(bucket#" in plan

    assert _rows(store.audit()) == _rows(audit_log(guard.decide(everything, base)))
    assert _rows(store.prices()) == _rows(guard.prices_after(everything, base))

    # a batch run again gives the same files, before and after compaction
    before = _rows(store.audit()), _rows(store.prices())
    store.apply(spark.createDataFrame(rows[180:], CHANGE_SCHEMA), 3, guard)
    assert (_rows(store.audit()), _rows(store.prices())) == before
    store.compact(3)
    assert _rows(store.prices()) == before[1]
    store.apply(spark.createDataFrame(rows[180:], CHANGE_SCHEMA), 3, guard)
    assert (_rows(store.audit()), _rows(store.prices())) == before
    # an empty batch and a change of an unknown reservation add nothing
    store.apply(everything.where("false"), 4, guard)
    store.apply(spark.createDataFrame([(999, T0, "admin", 77, Decimal(1))], CHANGE_SCHEMA), 5, guard)
    assert (_rows(store.audit()), _rows(store.prices())) == before
    store.apply(spark.createDataFrame([(1000, T0, "admin", 1, Decimal("8.88"))], CHANGE_SCHEMA), 6, guard)
    assert store.prices().where("rezervasyon_id = 1").first().adr == Decimal("8.88")
    assert store.prices(before=6).where("rezervasyon_id = 1").first().adr != Decimal("8.88")


def test_repeated_delivery_is_dropped(spark, tmp_path):
    rows = _changes(10)
    spark.createDataFrame(rows + rows, CHANGE_SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = without_repeats(spark.readStream.schema(CHANGE_SCHEMA).parquet(str(tmp_path / "in")), "1 hour")
    query = stream.writeStream.format("memory").queryName("once").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert spark.table("once").count() == 10


def test_bar_files_are_checked_and_appended_by_year(spark, tmp_path):
    source, out, bad = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "bad")
    source.mkdir()
    head = "date,open,high,low,close,volume,Name\n"
    (source / "1.csv").write_text(head + "2013-02-08,15.07,15.12,14.63,14.75,84,AAL\n2012-12-31,1,1,1,1,1,AAL\n2018-12-31,1,1,1,2,1,AAL\n")

    def run():
        rows = bars_stream.read_stream(spark, str(source))
        for query in bars_stream.start(rows, out, bad, str(tmp_path / "check")):
            query.awaitTermination(60)

    run()
    (source / "2.csv").write_text(head + "2019-01-01,1,1,1,1,1,AAL\n2013-13-01,1,1,1,1,1,AAL\n2014-01-02,,1,1,1,1,ABCDEFGHIJKL\n2014-01-02,1,1,1,1,1,AAL\n")
    run()
    run()  # nothing new, nothing twice
    good = spark.read.parquet(out)
    bars_csv.load(spark, str(source / "1.csv"), str(tmp_path / "loaded"))
    kinds = lambda df: sorted(df.dtypes)
    assert kinds(bars_stream.streamed_bars(spark, out)) == kinds(spark.read.parquet(str(tmp_path / "loaded")))
    assert good.select("id").distinct().count() == 3
    assert sorted((str(r.trade_date), r.trade_year) for r in good.collect()) == [
        ("2013-02-08", 2013),
        ("2014-01-02", 2014),
        ("2018-12-31", 2018),
    ]
    assert good.where("trade_year = 2013").first().daily_change == Decimal("-0.3200")
    reasons = sorted(r.reason for r in spark.read.parquet(bad).select("reason").collect())
    assert reasons == [
        "open_price: missing or malformed; symbol: missing or malformed",
        "trade_date: missing or malformed",
        "trade_date: no partition",
        "trade_date: no partition",
    ]
