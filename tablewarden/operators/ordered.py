"""Order-dependent operators that hold when one group has most of the rows.

A plain window puts a whole group into one task. Each operator here first asks,
with a counted and column-pruned pass, whether any group is above
``rows_per_task``. If none is, the plain window is used. If some are, those
groups are cut into pieces of counted rows, and the pieces are joined by small
summaries, so the result is the same and no task holds more than a piece. A
null is a group, a day or a place in the order like any other, and comes first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewarden.functions.exact import unit_mean, units
from tablewarden.session import ROWS_PER_TASK, scratch_dir

CHUNK = "_chunk"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a small table to the shared scratch folder and read it back.

    The read has a known file size, so Catalyst checks it before a broadcast.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def crowded_groups(df: DataFrame, keys: Sequence[str], rows_per_task: int) -> DataFrame | None:
    """Keys of the groups above ``rows_per_task``, or None when there are none.

    At most (rows / rows_per_task) keys can be in the result.
    """
    crowded = df.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > rows_per_task)
    if crowded.isEmpty():
        return None
    return settle(crowded.select(*keys), "crowded")


def same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equal keys, where two nulls are equal."""
    out = F.lit(True)
    for k in keys:
        out = out & left[k].eqNullSafe(right[k])
    return out


def with_chunk(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_task: int
) -> tuple[DataFrame, bool]:
    """Add a chunk number: 0 for ordinary groups, from 1 on, rising with ``order``, for crowded ones.

    Crowded groups are dealt out by ranges of key and order into twice as many
    pieces as their rows need; rows that tie go by a hash of the whole row, so
    a day or a null that has most of the rows is cut as well. The pieces are
    written, so that every later step sees the same ones.
    """
    crowded = crowded_groups(df, keys, rows_per_task)
    if crowded is None:
        return df.withColumn(CHUNK, F.lit(0).cast("bigint")), False
    ordinary = df.join(crowded, same(df, crowded, keys), "left_anti")
    full = df.join(crowded, same(df, crowded, keys), "left_semi")
    pieces = -(-2 * full.count() // rows_per_task)
    dealt = full.repartitionByRange(int(pieces), *keys, *order, F.xxhash64(*df.columns))
    dealt = settle(dealt.withColumn(CHUNK, (F.spark_partition_id() + 1).cast("bigint")), "chunks")
    return ordinary.withColumn(CHUNK, F.lit(0).cast("bigint")).unionByName(dealt), True


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, rows_per_task: int, descending: bool = False
) -> DataFrame:
    """Place of each row in its group, from 1. Rows that tie in ``order`` get places in any order."""
    rows, split = with_chunk(df, keys, order, rows_per_task)
    ordered = lambda c: F.col(c).desc() if descending else F.col(c).asc()
    place = F.row_number().over(W.partitionBy(*keys, CHUNK).orderBy(*map(ordered, order))).cast("bigint")
    if not split:
        return rows.withColumn(name, place).drop(CHUNK)
    before = W.partitionBy(*keys).orderBy(ordered(CHUNK)).rowsBetween(W.unboundedPreceding, -1)
    # one row for each piece of a group
    offsets = (
        rows.groupBy(*keys, CHUNK)
        .agg(F.count("*").alias("_rows"))
        .select(*keys, CHUNK, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    placed = rows.withColumn(name, place)
    joined = placed.join(offsets, same(placed, offsets, [*keys, CHUNK]))
    out = [placed[c] for c in df.columns]
    return joined.select(*out, (F.col("_offset") + F.col(name)).alias(name))


def position_in_group(
    df: DataFrame, group: str, seq: str, name: str, rows_per_task: int = ROWS_PER_TASK, descending: bool = False
) -> DataFrame:
    """Place of each row in its group, from 1, in order of ``seq``."""
    return numbered(df, [group], [seq], name, rows_per_task, descending)


def _means(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, spans: Mapping[str, int]) -> DataFrame:
    def one(span: int) -> Column:
        w = W.partitionBy(*keys).orderBy(*order).rowsBetween(-(span - 1), 0)
        return unit_mean(F.sum("_units").over(w), F.count("_units").over(w), 4)

    # whole numbers slide faster than decimals and stay exact
    rows = rows.withColumn("_units", units(F.col(value), 4, "bigint"))
    return rows.withColumns({name: one(span) for name, span in spans.items()}).drop("_units")


def moving_means(
    bars: DataFrame,
    spans: Mapping[str, int],
    *,
    key: str = "symbol",
    day: str = "trade_date",
    value: str = "close_price",
    ties: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Mean of the last ``span`` rows per key, current row included.

    The first rows of a key average what exists. ``ties`` orders rows of the
    same key and day.
    """
    crowded = crowded_groups(bars, [key], rows_per_task)
    if crowded is None:
        return _means(bars, [key], [day, *ties], value, spans)

    ordinary = _means(bars.join(crowded, same(bars, crowded, [key]), "left_anti"), [key], [day, *ties], value, spans)
    full = bars.join(crowded, same(bars, crowded, [key]), "left_semi")
    rows = numbered(full, [key], [day, *ties], "_pos", rows_per_task).withColumn("_pos", F.col("_pos") - 1)

    # each block also gets the tail of the block before it
    tail = max(spans.values()) - 1
    size = max(rows_per_task, tail, 1)
    block = F.floor(F.col("_pos") / size)
    homes = F.when(F.col("_pos") % size >= size - tail, F.array(block, block + 1)).otherwise(F.array(block))
    spread = rows.withColumn("_home", block).withColumn("_block", F.explode(homes))
    means = _means(spread, [key, "_block"], ["_pos"], value, spans).where(F.col("_home") == F.col("_block"))
    return ordinary.unionByName(means.select(*ordinary.columns))
