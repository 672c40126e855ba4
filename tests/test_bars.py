import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablewarden.operators.derived import with_bar_columns, with_load_time
from tablewarden.plans import bars as B
from tablewarden.schemas import BARS_COMMENT
from tablewarden.sources import bars_csv, layout, testtables

SCHEMA = (
    "symbol string, trade_date date, open_price decimal(12,4), high_price decimal(12,4), "
    "low_price decimal(12,4), close_price decimal(12,4), volume long"
)


def _bar(symbol, day, open_, close, volume=100):
    o, c = Decimal(open_), Decimal(close)
    return (symbol, day, o, max(o, c) + 1, min(o, c) - 1, c, volume)


def _df(spark, rows):
    return with_bar_columns(spark.createDataFrame(rows, SCHEMA))


def test_rank_keeps_ties_at_the_last_place_and_zero_open_gives_no_percent(spark):
    d = date(2017, 3, 1)
    moves = {"A": 9, "B": 8, "C": 7, "D": 6, "E": 5, "F": 5, "G": 4}
    rows = [_bar(s, d, 10, 10 + m) for s, m in moves.items()] + [_bar("Z", d, 0, 20)]
    rows.append(_bar("LOW", d, 1, 99, volume=10))
    got = {r.symbol: (r.siralama, r.degisim_yuzdesi) for r in B.top_movers_daily(_df(spark, rows), d, 50).collect()}
    assert got == {
        "Z": (1, None),
        "A": (2, Decimal("90.00")),
        "B": (3, Decimal("80.00")),
        "C": (4, Decimal("70.00")),
        "D": (5, Decimal("60.00")),
    }
    rows = [r for r in rows if r[0] != "Z"]
    got = {r.symbol: r.siralama for r in B.top_movers_daily(_df(spark, rows), d, 50).collect()}
    assert got == {"A": 1, "B": 2, "C": 3, "D": 4, "E": 5, "F": 5}


def test_yearly_return_weighs_by_days_and_needs_four_years(spark):
    rows = []
    for year, closes in [(2013, [10, 20]), (2014, [10, 11, 12]), (2015, [4]), (2016, [5, 10])]:
        rows += [_bar("FOUR", date(year, 1, 2) + timedelta(days=i), 1, c) for i, c in enumerate(closes)]
        if year < 2016:
            rows += [_bar("THREE", date(year, 1, 2), 1, 5)]
    # by days: (2*100 + 3*20 + 1*0 + 2*100) / 8
    assert [tuple(r) for r in B.avg_yearly_return(_df(spark, rows)).collect()] == [("FOUR", Decimal("57.50"))]
    equal = B.avg_yearly_return(_df(spark, rows), equal_years=True).collect()
    assert [tuple(r) for r in equal] == [("FOUR", Decimal("55.00"))]


def test_yearly_return_ignores_years_starting_at_zero(spark):
    rows = [_bar("S", date(y, 1, 2 + i), 1, c) for y in range(2013, 2017) for i, c in enumerate([0 if y == 2013 else 10, 20])]
    assert B.avg_yearly_return(_df(spark, rows)).first()[1] == Decimal("100.00")


def test_moving_averages_start_with_what_exists(spark):
    rows = [_bar("S", date(2015, 1, 1) + timedelta(days=i), 1, i + 1) for i in range(120)]
    got = B.moving_averages(_df(spark, rows), "S").collect()
    assert len(got) == 100
    assert got[0].hareketli_ort_20g == 1 and got[1].hareketli_ort_50g == Decimal("1.5000")
    assert got[99].hareketli_ort_20g == Decimal("90.5000") and got[99].hareketli_ort_50g == Decimal("75.5000")


def test_peaks_differ_when_the_day_filter_comes_first(spark):
    day = date(2017, 1, 3)
    df = _df(spark, [_bar("S", day, 1, 5), _bar("S", day, 1, 5), _bar("S", date(2016, 1, 4), 1, 50)])
    assert [r[3] for r in B.peak_all_time(df, day).collect()] == [50, 50]
    assert [r[3] for r in B.peak_correlated(df, day).collect()] == [50, 50]
    assert [r[3] for r in B.peak_same_day(df, day).collect()] == [5]


def test_summary_of_an_empty_table_is_one_row(spark):
    assert [tuple(r) for r in B.load_summary(_df(spark, [])).collect()] == [(0, 0, None, None)]
    assert B.year_share(_df(spark, [])).count() == 0
    few = _df(spark, [_bar(s, date(2015, 1, 1), 1, 2) for s in "ABBC"])
    assert B.load_summary(few).first()[1] == B.load_summary(few, approximate=True).first()[1] == 3


def test_strict_load(spark, tmp_path):
    head = "date,open,high,low,close,volume,name\n"
    (tmp_path / "a.csv").write_text(head + "2013-02-08,15.07,15.12,14.63,14.75005,8407500,AAL\n")
    row = bars_csv.read_bars(spark, str(tmp_path / "a.csv")).first()
    assert row.close_price == Decimal("14.7501") and row.daily_change == Decimal("-0.3199") and row.symbol == "AAL"
    bad = [
        "2013-02-30,1,1,1,1,1,AAL",
        "2013-02-08,,1,1,1,1,AAL",
        "2013-02-08,x,1,1,1,1,AAL",
        "2013-02-08,1,1,1,1,1.5,AAL",
        "2013-02-08,1,1,1,1,1,ABCDEFGHIJK",
        "2013-02-08,1,1,1,1,1",
        "2013-02-08,123456789,1,1,1,1,AAL",
    ]
    for i, line in enumerate(bad):
        path = tmp_path / f"bad{i}.csv"
        path.write_text(head + line + "\n")
        with pytest.raises(Exception):
            bars_csv.read_bars(spark, str(path)).collect()


def test_load_adds_id_and_time(spark, tmp_path):
    (tmp_path / "a.csv").write_text("d,o,h,l,c,v,s\n2013-02-08,1,2,0.5,1.5,10,AAL\n2013-02-11,1,2,0.5,1.5,10,AAL\n")
    bars_csv.load(spark, str(tmp_path / "a.csv"), str(tmp_path / "out"))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len({r.id for r in rows}) == 2 and all(r.created_at is not None for r in rows)
    assert "created_at" in with_load_time(spark.range(1)).columns


def test_year_layout_prunes_and_counts(spark, tmp_path):
    path = str(tmp_path / "bars")
    rows = [_bar(s, date(y, 6, d), 1, y) for s in ("A", "B") for y in (2016, 2017, 2018) for d in (1, 2)]
    df = _df(spark, rows)
    layout.write_by_year(df, path)
    table = layout.read_by_year(spark, path)
    span = (date(2017, 1, 1), date(2017, 12, 31))
    pruned = table.where(layout.between_dates(*span))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "trade_year" in filters and "2017" in filters
    assert {f.split("trade_year=")[1][:4] for f in pruned.select("close_price").inputFiles()} >= {"2017"}
    assert B.top_avg_close(pruned, *span).collect() == B.top_avg_close(df, *span).collect()
    inventory = layout.partition_inventory(spark, path).collect()
    assert [(r.trade_year, r.satir_sayisi) for r in inventory] == [(2016, 4), (2017, 4), (2018, 4)]
    assert all(r.bayt > 0 and r.boyut.endswith("bytes") for r in inventory)
    assert layout.table_size(table).first().bayt == sum(r.bayt for r in inventory)
    # as a catalog table, registered twice without harm
    for _ in range(2):
        layout.register(spark, "bars_table", path)
    assert spark.table("bars_table").count() == 12
    described = {r.col_name: r.data_type for r in spark.sql("describe extended bars_table").collect()}
    assert described["Comment"] == BARS_COMMENT and "bytes" in described["Statistics"]
    spark.sql("drop table bars_table")
    # overwriting one year keeps the others
    layout.write_by_year(df.where("trade_date < '2017-01-01'").limit(1), path)
    assert [r.satir_sayisi for r in layout.partition_inventory(spark, path).collect()] == [1, 4, 4]


def test_plans_push_filters_and_limit_early(spark):
    from tablewarden.sources import testtables as src

    bars = src.bars(spark, "/root/testdata/sf0.001")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    scan = plan(B.range_scan(bars, "Brand#13", date(1997, 1, 1), date(1998, 12, 31), ["trade_date", "close_price"]))
    assert "EqualTo(p_brand,Brand#13)" in scan and "GreaterThanOrEqual(l_shipdate" in scan and "l_tax" not in scan
    movers = plan(B.top_movers_daily(bars, date(2000, 1, 1), 50))
    assert "WindowGroupLimit" in movers and "Partial" in movers and "TakeOrderedAndProject" in movers
    assert "SortAggregate" not in plan(B.avg_yearly_return(bars))
    assert "TakeOrderedAndProject" in plan(B.top_volume(bars))


def test_repeated_days_and_wide_returns(spark):
    """Of one day's rows the lowest close comes first, the highest last; a return may be very large."""
    rows = [("A", date(2015, 1, 2), p) for p in ("30", "10", "20")] + [("A", date(2015, 12, 30), p) for p in ("40", "50")]
    rows += [("B", date(2015, 1, 2), "0.0001"), ("B", date(2015, 12, 30), "99999999")]
    for some in (rows, rows[::-1]):
        df = spark.createDataFrame(some, "symbol string, trade_date date, p string")
        df = df.withColumn("close_price", F.col("p").cast("decimal(12,4)"))
        got = {r.symbol: (r.yil_basi_fiyat, r.yil_sonu_fiyat, r.getiri) for r in B.yearly_returns(df).collect()}
        assert got["A"] == (Decimal("10"), Decimal("50"), Decimal("400"))
        assert got["B"][2] == Decimal("99999998999900")
        assert B.avg_yearly_return(df, years=1).count() == 2


def test_both_orders_of_trades_agree(spark, monkeypatch):
    rng = random.Random(4)
    key = lambda: (rng.randint(0, 3), rng.randint(0, 2), rng.randint(0, 2), rng.randint(0, 2))
    rows = [(*key(), float(rng.randint(1, 99)), 3.0, datetime(1996, 1, rng.randint(1, 3))) for _ in range(400)]
    # repeated keys carry one price
    rows = list({r[:4]: r for r in rows}.values()) * 2
    schema = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double, l_shipdate timestamp"
    parts = spark.createDataFrame([(i, f"B{i % 2}") for i in range(3)], "p_partkey long, p_brand string")
    small = spark.createDataFrame(rows, schema)
    assert dict(small.select(testtables.trade_order(small).alias("k")).dtypes)["k"] == "bigint"
    wide = small.withColumn("l_partkey", F.col("l_partkey") + 10**10).withColumn("l_orderkey", F.col("l_orderkey") + 10**13)
    assert dict(wide.select(testtables.trade_order(wide).alias("k")).dtypes)["k"] == "decimal(38,0)"
    wide_parts = parts.withColumn("p_partkey", F.col("p_partkey") + 10**10)
    got = [sorted(map(str, testtables.bars_of(*x).collect())) for x in ((small, parts), (wide, wide_parts))]
    assert got[0] == got[1] and len(got[0]) > 4
    assert testtables.bars_of(small.limit(0), parts).count() == 0
