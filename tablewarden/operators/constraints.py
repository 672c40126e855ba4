"""Declared constraints as data-quality reports.

Each report is one aggregate with a map-side step, so a value that fills most
rows reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.text import number_fault


def _per_column(counts: DataFrame, names: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One row of per-column results as one row per column."""
    rows = F.array(
        *[F.struct(F.lit(n).alias("column_name"), *[F.col(f"{f}_{i}").alias(f) for f in fields]) for i, n in enumerate(names)]
    )
    return counts.select(F.explode(rows).alias("r")).select("r.*").where(F.col("violations") > 0)


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns with nulls and how many."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"violations_{i}") for i, c in enumerate(columns)])
    return _per_column(counts, columns, ["violations"])


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys seen more than once. Rows with a null key part are not compared."""
    whole = df.dropna(subset=list(keys)) if keys else df
    return whole.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def foreign_key(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Values without a parent and their rows; a null value passes.

    Child rows are counted per value first, so a crowded value joins as one row.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("orphans"))
    return used.join(parent.select(F.col(key).alias(column)), column, "left_anti")


def lengths(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Columns with texts above their limit, how many and the longest."""
    aggs = []
    for i, (name, limit) in enumerate(limits.items()):
        # as the loaders: blanks at the end do not count
        size = F.length(F.rtrim(name))
        aggs += [F.count_if(size > limit).alias(f"violations_{i}"), F.max(size).alias(f"longest_{i}")]
    return _per_column(df.agg(*aggs), list(limits), ["violations", "longest"])


def numerics(df: DataFrame, column: str, precision: int, scale: int) -> DataFrame:
    """Reasons why texts are no decimal(precision, scale), with counts."""
    fault = number_fault(F.col(column), precision, scale)
    return df.groupBy(fault.alias("reason")).agg(F.count("*").alias("violations")).where(F.col("reason").isNotNull())


def outside_years(day: Column, first: int, last: int) -> Column:
    """True when no partition takes the day; a missing day has none."""
    return ~F.coalesce(F.year(day).between(first, last), F.lit(False))


def partition_range(df: DataFrame, day: str, first: int, last: int) -> DataFrame:
    """Years without a partition and their rows."""
    return (
        df.where(outside_years(F.col(day), first, last))
        .groupBy(F.year(day).alias("trade_year"))
        .agg(F.count("*").alias("violations"))
    )


def with_faults(df: DataFrame, rules: Mapping[str, Column], name: str = "faults") -> DataFrame:
    """Names of the broken rules of each row; a rule is true where it is broken."""
    broken = [F.when(rule, F.lit(rule_name)) for rule_name, rule in rules.items()]
    return df.withColumn(name, F.array_compact(F.array(*broken)))
