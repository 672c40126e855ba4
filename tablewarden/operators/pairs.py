"""Members of a group paired once each, as counts.

Pairs with equal group and lower id grow with the square of the group, so they
are counted and never listed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.operators.ordered import position_in_group
from tablewarden.schemas import PAIR_WARNING
from tablewarden.session import ROWS_PER_TASK


def pairs_in_group(df: DataFrame, group: str, id_column: str) -> DataFrame:
    """Members and pairs of every group with at least two members."""
    n = F.col("uye_sayisi")
    # one factor of n * (n - 1) is even; widened so a large group cannot overflow
    pairs = F.call_function("div", n.cast("decimal(20,0)") * (n - 1).cast("decimal(18,0)"), F.lit(2))
    return (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count("*").alias("uye_sayisi"), F.min(id_column).alias("ilk_uye"), F.max(id_column).alias("son_uye"))
        .where(n > 1)
        .withColumn("cift_sayisi", pairs.cast("bigint"))
        .withColumn("uyari", F.lit(PAIR_WARNING))
    )


def later_partners(df: DataFrame, group: str, id_column: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """For each member, how many members of its group have a higher id."""
    rows = df.where(F.col(group).isNotNull()).select(group, id_column)
    # counted from the highest id down, the place itself is the answer
    placed = position_in_group(rows, group, id_column, "_place", rows_per_task, descending=True)
    return placed.select(group, id_column, (F.col("_place") - 1).alias("sonraki_uye"))
