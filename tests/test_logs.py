from datetime import datetime, timedelta
from decimal import Decimal

from tablewarden.plans import logs as L
from tablewarden.schemas import QUERY_LOG
from tablewarden.sources import querylog

T0 = datetime(2024, 1, 1)


def _log(spark, rows):
    full = [(i, T0 + timedelta(seconds=i), "u", text, None if ms is None else Decimal(ms), n, "note") for i, (text, ms, n) in enumerate(rows)]
    return spark.createDataFrame(full, QUERY_LOG)


def test_slow_statements_group_whole_texts(spark):
    long = "SELECT * FROM Stock_Prices " + "x" * 200
    log = _log(spark, [(long + "1", "10", 1), (long + "2", "20", 2), (long + "2", "21", 3), ("SELECT 1", "99", 1), (long + "3", None, 1)])
    got = L.slow_statements(log).collect()
    assert [(r.cagri_sayisi, r.ortalama_sure_ms, r.toplam_satir) for r in got] == [
        (1, None, 1),  # descending order puts a missing mean first
        (2, Decimal("20.50"), 5),
        (1, Decimal("10.00"), 1),
    ]
    assert {r.sorgu_ozeti for r in got} == {long[:100]}


def test_ratio_guards(spark):
    got = L.rows_per_call(_log(spark, [("a", "0", 7), ("a", "0", 8)])).first()
    assert got.cagri_basina_satir == Decimal("7.5") and got.ms_basina_satir is None


def test_usage_bands(spark):
    known = spark.createDataFrame([(0,), (1,), (2,)], "k int")
    uses = spark.createDataFrame([(1,)] * 9 + [(2,)] * 10 + [(7,)], "k int")
    got = {r.k: (r.kullanim_sayisi, r.oneri.split(" ")[0], r.durum) for r in L.usage_bands(known, "k", uses).collect()}
    assert got == {0: (0, "KALDIR", "KULLANIMIYOR - Kaldir!"), 1: (9, "GOZDEN", "Aktif"), 2: (10, "Aktif", "Aktif")}


def test_statement_ages(spark):
    log = _log(spark, [("SELECT a", "1", 1), ("select PG_STAT_ACTIVITY", "1", 1)])
    got = L.statement_ages(log, datetime(2024, 1, 1, 0, 1, 0, 5000), "idle", "%pg_stat_activity%").collect()
    assert [(r.pid, r.sure_saniye) for r in got] == [(0, Decimal("60.01"))]


def test_timed_runs_of_two_layouts_end_in_the_report(spark, tmp_path):
    path = str(tmp_path / "log")
    for i, note in enumerate(["plain", "by year"]):
        assert querylog.timed_run(spark.range(10 + i), path, user="analyst", text="count", notes=note) == 10 + i
    log = querylog.read_log(spark, path)
    assert log.count() == 2 and log.where("duration_ms > 0 and username = 'analyst'").count() == 2
    assert [(r.test_tipi, r.satir_sayisi) for r in L.latest_log(log).collect()] == [("by year", 11), ("plain", 10)]
