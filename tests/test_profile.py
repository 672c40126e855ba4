"""What a query counted while it ran, and timings of whole queries."""

import pytest
from pyspark.sql import functions as F

from tablewarden.operators import profile as P
from tablewarden.sources import layout, querylog


@pytest.fixture()
def table(spark, tmp_path):
    rows = spark.range(3000).selectExpr(
        "date_add(date'2013-01-01', cast(id % 1000 as int)) as trade_date", "concat('S', id % 7) as symbol", "cast(id as double) as v"
    )
    layout.write_by_year(rows, str(tmp_path / "bars"))
    return layout.read_by_year(spark, str(tmp_path / "bars"))


def _one(profiled, operator):
    return profiled.where(F.col("operator") == operator).orderBy("id").collect()


def test_rows_files_and_bytes(spark, table):
    expected = table.where("trade_year = 2013").select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s"))
    files = expected.distinct().collect()
    query = table.where("trade_year = 2013 and v % 2 = 1").groupBy("symbol").agg(F.sum("v").alias("v"))
    for _ in range(2):  # counters start anew with each run
        steps = P.profile(query)
        (scan,), (picked,) = _one(steps, "Scan"), _one(steps, "Filter")
        odd = table.where("trade_year = 2013 and v % 2 = 1").count()
        assert (scan.rows_out, picked.rows_out) == (table.where("trade_year = 2013").count(), odd)
        assert (scan.files_read, scan.folders_read, scan.bytes_read) == (len(files), 1, sum(f.s for f in files))
        root = steps.where("id = 0").first()
        assert (root.operator, root.rows_out, root.parent, root.depth) == ("HashAggregate", 7, None, 0)
        (exchange,) = _one(steps, "Exchange")
        assert exchange.rows_out >= 7 and exchange.bytes_shuffled > 0 and exchange.metrics["numPartitions"] == 4
    by_id = {r.id: r for r in steps.collect()}
    assert all(by_id[r.parent].depth == r.depth - 1 for r in by_id.values() if r.id)


def test_the_final_plan_is_shown(spark, table):
    few = spark.createDataFrame([("S1",), ("S2",)], "symbol string")
    steps = P.profile(table.join(few, "symbol"))
    (join,) = _one(steps, "BroadcastHashJoin")
    assert join.rows_out == table.where("symbol in ('S1', 'S2')").count()
    assert _one(steps, "BroadcastExchange")[0].bytes_broadcast > 0
    once = table.groupBy("symbol").count()
    again = P.profile(once.unionAll(once))
    assert [r.reused for r in again.where("operator like '%Exchange'").orderBy("id").collect()] == [False, True]


def test_sorts_columns_and_subqueries_run(spark, table):
    run = P.run(table.orderBy("v").select("symbol", "v"))
    assert run.rows == 3000 and run.duration_ms > 0 and run.steps[0].operator in ("Sort", "Project")
    assert "Sort" in run.text() and "files_read=" in run.text() and run.text().endswith("ms")
    table.createOrReplaceTempView("profiled_bars")
    sub = P.run(spark.sql("select * from profiled_bars where v > (select avg(v) from profiled_bars)"))
    assert sub.rows == 1500 and sum(s.operator == "Scan" for s in sub.steps) == 2
    assert P.run(spark.createDataFrame([], "a int")).rows == 0
    # a failing query fails
    with pytest.raises(Exception, match="stop here"):
        P.run(table.select(F.raise_error(F.lit("stop here"))))


def test_a_timed_query_keeps_its_sort_and_columns(spark, table, monkeypatch):
    query = table.orderBy("v").withColumn("h", F.sha2("symbol", 256))
    written = []
    frame = type(query)
    monkeypatch.setattr(frame, "count", lambda self: pytest.fail("count() drops sorts and columns"))
    observe = frame.observe
    monkeypatch.setattr(frame, "observe", lambda self, *a: written.append(observe(self, *a)) or written[-1])
    rows, took = querylog.run_whole(query)
    assert rows == 3000 and took > 0
    plan = written[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort [v" in plan and "sha2" in plan and "CollectMetrics" in plan
    assert querylog.run_whole(table.where("false"))[0] == 0
