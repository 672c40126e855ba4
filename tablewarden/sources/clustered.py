"""Tables clustered by several columns at once, with statistics that choose the files to read.

Each column is ranked by its own quantiles, so that every rank holds about as
many rows, and the bits of the ranks are interleaved: rows that are near in all
columns get near numbers (a Z-order curve). Files are ranges of that number,
so a filter on any one of the columns meets a part of the files, where sorting
by one column after the other serves the first only.

``data/``   the rows; each file is a range of the curve
``stats/``  for each file its rows, and least and largest value of each column

A reader looks the filter up in ``stats`` and opens only files that can hold
a row.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a column's rank; a column has at most 2**RANK_BITS ranks.
RANK_BITS = 8
#: How fine the quantiles are.
ACCURACY = 10_000
_CURVE, _FILE, _ROWS, _NULLS = "_curve", "_file", "_rows", "_nulls"


def _as_number(name: str, kind: T.DataType, skipped: int = 0) -> Column:
    """A whole number that rises with the value, though not always strictly.

    A text counts by seven bytes behind the ``skipped`` ones that all texts
    begin with.
    """
    value = F.col(name)
    if isinstance(kind, T.StringType):
        digits = F.substring(F.hex(value.cast("binary")), 2 * skipped + 1, 14)
        return F.conv(F.rpad(digits, 14, "0"), 16, 10).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("bigint")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp"))
    if isinstance(kind, T.DecimalType):
        return F.floor(value.cast("double") * 10**kind.scale).cast("double")
    if isinstance(kind, T.NumericType):
        return value
    raise TypeError(f"{name}: cannot cluster by {kind.simpleString()}")


def _numbers(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Each column as a number; for texts one pass finds what all of them begin with."""
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    skipped = {}
    if texts:
        ends = df.agg(*[f(c).alias(f"{name}_{c}") for c in texts for f, name in ((F.min, "least"), (F.max, "largest"))]).first()
        for c in texts:
            pair = [(ends[f"{name}_{c}"] or "").encode("utf-8") for name in ("least", "largest")]
            skipped[c] = len(os.path.commonprefix(pair))
    return [_as_number(c, df.schema[c].dataType, skipped.get(c, 0)) for c in columns]


def _bounds(df: DataFrame, numbers: Sequence[Column]) -> list[list]:
    """Quantiles of each number, in one pass; how many does not depend on the rows."""
    shares = [i / 2**RANK_BITS for i in range(1, 2**RANK_BITS)]
    quantiles = [F.percentile_approx(n, shares, ACCURACY).alias(f"q{i}") for i, n in enumerate(numbers)]
    return [sorted(q or []) for q in df.agg(*quantiles).first()]


def _rank(number: Column, bounds: list) -> Column:
    """How many bounds are below a number, by halving; a null ranks first.

    A value that fills several quantiles takes several ranks, so the ranks of
    any column run over all of their bits.
    """
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(b) for b in bounds])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(RANK_BITS))])
    halved = F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.element_at(table, at + step) < number, at + step).otherwise(at)
    )
    return F.coalesce(halved, F.lit(0))


def curve(df: DataFrame, columns: Sequence[str]) -> Column:
    """The place of a row on the curve through the ranks of the columns."""
    if len(columns) * RANK_BITS > 62:
        raise ValueError("too many columns for one number")
    numbers = _numbers(df, columns)
    ranks = [_rank(n, b) for n, b in zip(numbers, _bounds(df, numbers), strict=True)]
    bits = [
        F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("bigint"), bit * len(ranks) + at)
        for bit in range(RANK_BITS)
        for at, rank in enumerate(ranks)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def write(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None) -> None:
    """Writes the rows in ranges of the curve, and the statistics of each file.

    Without ``files`` the planner chooses their number by size. Rows at one
    place of the curve are cut by a hash of the row, so a value that most rows
    have fills many files.
    """
    by = [F.col(_CURVE), F.xxhash64(*df.columns)]
    placed = df.withColumn(_CURVE, curve(df, columns))
    dealt = placed.repartitionByRange(files, *by) if files else placed.repartitionByRange(*by)
    dealt.sortWithinPartitions(_CURVE).drop(_CURVE).write.mode("overwrite").parquet(f"{path}/data")
    # one row for each file; the columns are read once more, column-pruned
    ends = [f(c).alias(f"{name}_{c}") for c in columns for f, name in ((F.min, "least"), (F.max, "largest"))]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"{_NULLS}_{c}") for c in columns]
    held = df.sparkSession.read.schema(df.schema).parquet(f"{path}/data")
    stats = held.groupBy(F.col("_metadata.file_path").alias(_FILE)).agg(F.count("*").alias(_ROWS), *ends, *nulls)
    stats.coalesce(1).write.mode("overwrite").parquet(f"{path}/stats")


def files_for(spark: SparkSession, path: str, ranges: Mapping[str, tuple]) -> DataFrame:
    """The files that may hold a row within all of the ranges (both ends included; None is open)."""
    stats = spark.read.parquet(f"{path}/stats")
    meets = F.lit(True)
    for column, (low, high) in ranges.items():
        if low is not None:
            meets = meets & (F.col(f"largest_{column}") >= F.lit(low))
        if high is not None:
            meets = meets & (F.col(f"least_{column}") <= F.lit(high))
    return stats.where(meets).select(_FILE, _ROWS)


def read(spark: SparkSession, path: str, ranges: Mapping[str, tuple] | None = None) -> DataFrame:
    """The rows within all of the ranges, from the files that may hold one.

    The names of those files go through the driver, not the rows. Without
    ranges, or with none that is bounded, every file is read.
    """
    whole = spark.read.parquet(f"{path}/data")
    ranges = {c: r for c, r in (ranges or {}).items() if r != (None, None)}
    if not ranges:
        return whole
    names = [r[0] for r in files_for(spark, path, ranges).select(_FILE).collect()]
    rows = spark.read.schema(whole.schema).parquet(*names) if names else whole.where("false")
    for column, (low, high) in ranges.items():
        if low is not None:
            rows = rows.where(F.col(column) >= F.lit(low))
        if high is not None:
            rows = rows.where(F.col(column) <= F.lit(high))
    return rows
