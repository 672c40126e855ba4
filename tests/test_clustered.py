"""Clustering by several columns: the same rows, from fewer files, whichever column is filtered."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tablewarden.operators import profile
from tablewarden.sources import clustered

SCHEMA = "symbol string, day date, v decimal(10,2), n int"


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    symbols = [f"S{i:02d}" for i in range(40)] + ["é", "", "S01"]
    out = []
    for _ in range(6000):
        hot = rng.random() < 0.34
        out.append(
            (
                "HOT" if hot else rng.choice([*symbols, None]),
                None if rng.random() < 0.02 else date(2010, 1, 1) + timedelta(days=rng.randint(0, 3000)),
                None,
                rng.randint(-500, 500),
            )
        )
    return spark.createDataFrame(out, SCHEMA)


def _files(df):
    return next(s.metrics["numFiles"] for s in profile.run(df).steps if s.operator == "Scan")


def test_either_column_spares_files(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    clustered.write(rows, path, ["symbol", "day"], files=32)
    assert sorted(map(str, clustered.read(spark, path).collect())) == sorted(map(str, rows.collect()))
    first, last = date(2012, 1, 1), date(2012, 4, 1)
    cases = [
        ({"symbol": ("S07", "S07")}, F.col("symbol") == "S07", 16),
        ({"day": (first, last)}, F.col("day").between(first, last), 16),
        ({"symbol": ("S07", "S20"), "day": (first, last)}, F.col("symbol").between("S07", "S20") & F.col("day").between(first, last), 10),
        ({"day": (None, first)}, F.col("day") <= first, 31),
        ({"symbol": ("HOT", "HOT")}, F.col("symbol") == "HOT", 24),
        ({"symbol": ("zz", None)}, F.col("symbol") >= "zz", 16),
    ]
    for ranges, same, most in cases:
        got = clustered.read(spark, path, ranges)
        assert sorted(map(str, got.collect())) == sorted(map(str, rows.where(same).collect()))
        assert _files(got) <= most, ranges
    # sorted by the symbol alone a filter on days meets nearly every file
    rows.repartitionByRange(32, "symbol", F.rand(1)).write.parquet(str(tmp_path / "plain"))
    stats = spark.read.parquet(str(tmp_path / "plain")).groupBy("_metadata.file_path").agg(F.min("day").alias("a"), F.max("day").alias("b"))
    assert stats.where((F.col("b") >= first) & (F.col("a") <= last)).count() > 24


def test_a_value_of_most_rows_fills_many_files(spark, tmp_path):
    rows = spark.range(5000).selectExpr("'one' as symbol", "date'2020-01-01' as day", "id")
    clustered.write(rows, str(tmp_path / "t"), ["symbol", "day"], files=8)
    sizes = [r[0] for r in clustered.files_for(spark, str(tmp_path / "t"), {}).select("_rows").collect()]
    assert len(sizes) == 8 and max(sizes) < 2500 and sum(sizes) == 5000


def test_odd_tables(spark, rows, tmp_path):
    empty = str(tmp_path / "empty")
    clustered.write(rows.limit(0), empty, ["symbol", "day"])
    assert clustered.read(spark, empty, {"symbol": ("a", "b")}).count() == 0
    nulls = str(tmp_path / "nulls")
    clustered.write(rows.where("false").unionAll(rows.limit(20).select(F.lit(None).cast("string"), F.lit(None).cast("date"), "v", "n")), nulls, ["symbol", "day", "v", "n"])
    assert clustered.read(spark, nulls).count() == 20 and clustered.read(spark, nulls, {"day": (date(2000, 1, 1), None)}).count() == 0
    with pytest.raises(TypeError, match="cannot cluster"):
        clustered.write(spark.range(1).selectExpr("array(id) as a"), nulls, ["a"])


def test_the_curve_interleaves_ranks(spark):
    rows = spark.range(16).selectExpr("id div 4 as a", "id % 4 as b")
    got = {(r.a, r.b): r.z for r in rows.withColumn("z", clustered.curve(rows, ["a", "b"])).collect()}
    order = sorted(got, key=got.get)
    # quarter after quarter of the square
    quarters = [{(a // 2, b // 2) for a, b in order[i : i + 4]} for i in range(0, 16, 4)]
    assert all(len(q) == 1 for q in quarters) and len(set(got.values())) == 16
