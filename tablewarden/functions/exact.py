"""Exact rounding, exact means and size text.

All of these are column expressions on integers or decimals, so a result does
not depend on the order in which partitions are merged.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(38,0)"


def units(value: Column, scale: int, kind: str = _WIDE) -> Column:
    """A decimal(p, scale) as a whole number of its smallest unit."""
    return (value * F.lit(10**scale).cast("decimal(10,0)")).cast(kind)


def ratio(numerator: Column, denominator: Column, digits: int, kind: str = _WIDE, precision: int = 18) -> Column:
    """``numerator / denominator`` of whole numbers, rounded half away from zero.

    A zero or null denominator gives null. The result is decimal(precision, digits).
    ``kind="bigint"`` is the fast form for use on every row; it raises an error
    when 2 * 10**digits * numerator does not fit.
    """
    num, den = numerator.cast(kind), denominator.cast(kind)
    # a zero divisor must not be evaluated under ANSI
    size = F.nullif(F.abs(den), F.lit(0).cast(kind))
    factor = F.lit(2 * 10**digits).cast("bigint" if kind == "bigint" else "decimal(18,0)")
    # a whole quotient is a bigint: for results beyond that the whole part is taken apart
    wide = precision > 18
    rest = (F.abs(num) % size).cast(kind) if wide else F.abs(num)
    rounded = F.call_function("div", (rest * factor + size).cast(kind), (size * F.lit(2)).cast(kind))
    if wide:
        whole = F.call_function("div", F.abs(num), size).cast("decimal(20,0)") * F.lit(10**digits).cast("decimal(18,0)")
        rounded = (whole + rounded.cast("decimal(20,0)")).cast(_WIDE)
    negative = (num < F.lit(0)) != (den < F.lit(0))
    whole = F.when(negative, -rounded).otherwise(rounded).cast(f"decimal({precision},0)")
    return (whole * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal({precision},{digits})")


def unit_mean(total: Column, rows: Column, scale: int) -> Column:
    """Mean of whole units of ``scale``, rounded to that scale; sums must fit a bigint."""
    whole = ratio(total, rows, 0, "bigint")
    return (whole * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal(18,{scale})")


def mean(total: Column, rows: Column, scale: int, digits: int) -> Column:
    """Mean of decimals of ``scale`` from their sum and count, rounded to ``digits``."""
    return ratio(units(total, scale), rows.cast(_WIDE) * F.lit(10**scale).cast("decimal(10,0)"), digits)


def size_text(size: Column) -> Column:
    """Bytes as text: plain below 10 kB, then kB/MB/GB/TB/PB rounded to whole units."""
    size = size.cast("bigint")
    # a unit is used while the value in half units is below this
    limit = 20 * 1024 - 1
    out = F.when(F.abs(size) < 10 * 1024, F.concat(size.cast("string"), F.lit(" bytes")))
    names = ["kB", "MB", "GB", "TB", "PB"]
    for power, name in enumerate(names, start=1):
        halves = F.call_function("div", size, F.lit(2 ** (10 * power - 1)))
        whole = F.call_function("div", halves + F.when(halves < 0, -1).otherwise(1), F.lit(2))
        text = F.concat(whole.cast("string"), F.lit(f" {name}"))
        out = out.when(F.abs(halves) < limit, text) if name != names[-1] else out.otherwise(text)
    return out
