import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tablewarden.functions.exact import mean, ratio, size_text, units


def test_ratio_rounds_half_away_from_zero(spark):
    rng = random.Random(1)
    pairs = [(1005, 1000), (-1005, 1000), (5, 0), (0, 7), (1, 3), (-1, 3), (1, -3), (None, 3), (3, None)]
    pairs += [(rng.randint(-10**9, 10**9), rng.choice([-1, 1]) * rng.randint(1, 10**6)) for _ in range(300)]
    df = spark.createDataFrame(pairs, "a long, b long")
    for a, b, got in df.select("a", "b", ratio(F.col("a"), F.col("b"), 2)).collect():
        if a is None or not b:
            assert got is None
        else:
            assert got == (Decimal(a) / Decimal(b)).quantize(Decimal("0.01"), ROUND_HALF_UP)


def test_mean_does_not_depend_on_order_and_is_null_when_empty(spark):
    df = spark.createDataFrame([(Decimal("1.0050"),), (Decimal("1.0050"),), (None,)], "x decimal(12,4)")
    m = mean(F.sum("x"), F.count("x"), 4, 2)
    assert df.agg(m).first()[0] == Decimal("1.01")
    assert df.where("false").agg(m).first()[0] is None


def test_units_holds_wide_sums(spark):
    df = spark.createDataFrame([(Decimal("999999999999999999.9999"),)], "x decimal(22,4)")
    assert df.select(units(F.col("x"), 4)).first()[0] == Decimal("9999999999999999999999")


# fixed values: bytes and their text
SIZES = [
    (0, "0 bytes"),
    (10239, "10239 bytes"),
    (10240, "10 kB"),
    (10751, "10 kB"),
    (10752, "11 kB"),
    (10485247, "10239 kB"),
    (10485248, "10 MB"),
    (10 * 2**20, "10 MB"),
    (600_000 * 100, "57 MB"),
    (10 * 2**30, "10 GB"),
    (100 * 2**40, "100 TB"),
    (20 * 2**50, "20 PB"),
    (-10240, "-10 kB"),
]


@pytest.mark.parametrize("size,text", SIZES)
def test_size_text(spark, size, text):
    assert spark.createDataFrame([(size,)], "n long").select(size_text(F.col("n"))).first()[0] == text
