"""Yearly figures kept as states that loads are merged into, so that reports read states and not bars.

``bars/load=<n>/trade_year=<y>``  the bars of a load
``states/load=<n>``               the states that this load has changed
``done/load=<n>``                 one row for each finished load

A state is one row for a symbol and year: rows, sums in whole units, lowest and
highest price, first and last close with their days, and a bitmap of the days
seen. Two states without a common day are merged column by column. Where the
bitmaps of the stored state and of the load meet, the load may correct stored
days, and lows, highs or first days cannot be taken back: only those groups are
computed anew from their bars. A load is repeated by writing its folders again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.functions.exact import units
from tablewarden.operators.ordered import settle
from tablewarden.sources.layout import YEAR

GROUP = ["symbol", YEAR]
LOAD = "load"
#: Words of 62 bits that hold the days of a year.
_WORDS = 6
_BITS = 62
_DAYS = [f"days_{i}" for i in range(_WORDS)]


def _order() -> Column:
    """Day and close as one long: of several bars of a day the lowest close is first, the highest last."""
    return F.unix_date("trade_date").cast("bigint") * 2 * 10**12 + units(F.col("close_price"), 4, "bigint")


def states(bars: DataFrame) -> DataFrame:
    """The state of each symbol and year of the bars; one hash aggregate."""
    day = F.dayofyear("trade_date") - 1
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (day % _BITS).cast("int"))
    seen = [F.when(F.floor(day / _BITS) == i, bit).otherwise(F.lit(0)) for i in range(_WORDS)]
    order = _order()
    return bars.groupBy(*GROUP).agg(
        F.count("*").alias("n_rows"),
        F.count("close_price").alias("n_close"),
        F.sum(units(F.col("close_price"), 4, "bigint")).cast("decimal(38,0)").alias("close_units"),
        F.sum("volume").alias("volume"),
        F.min("low_price").alias("low"),
        F.max("high_price").alias("high"),
        F.min(order).alias("first_order"),
        F.min_by("close_price", order).alias("first_close"),
        F.max(order).alias("last_order"),
        F.max_by("close_price", order).alias("last_close"),
        F.min("trade_date").alias("first_day"),
        F.max("trade_date").alias("last_day"),
        *[F.bit_or(word).alias(name) for word, name in zip(seen, _DAYS, strict=True)],
    )


def _merged(a: str, b: str) -> list[Column]:
    """The columns of two states without a common day as those of one; either may be missing."""
    left, right = (lambda c: F.col(f"{a}.{c}")), (lambda c: F.col(f"{b}.{c}"))

    def added(c: str) -> Column:
        both = F.coalesce(left(c), F.lit(0)) + F.coalesce(right(c), F.lit(0))
        return F.when(left(c).isNotNull() | right(c).isNotNull(), both.cast("decimal(38,0)" if c == "close_units" else "bigint")).alias(c)

    def earlier(c: str) -> Column:
        use_left = right("first_order").isNull() | (left("first_order") <= right("first_order"))
        return F.when(use_left, left(c)).otherwise(right(c)).alias(c)

    def later(c: str) -> Column:
        use_left = right("last_order").isNull() | (left("last_order") >= right("last_order"))
        return F.when(use_left, left(c)).otherwise(right(c)).alias(c)

    return [
        *[added(c) for c in ("n_rows", "n_close", "close_units", "volume")],
        F.least(left("low"), right("low")).alias("low"),
        F.greatest(left("high"), right("high")).alias("high"),
        earlier("first_order"),
        earlier("first_close"),
        later("last_order"),
        later("last_close"),
        F.least(left("first_day"), right("first_day")).alias("first_day"),
        F.greatest(left("last_day"), right("last_day")).alias("last_day"),
        *[F.coalesce(left(c), F.lit(0)).bitwiseOR(F.coalesce(right(c), F.lit(0))).alias(c) for c in _DAYS],
    ]


class StateStore:
    """Bars and their yearly states below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _finished(self, before: int) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/done")
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(n for n in (int(x.removeprefix(f"{LOAD}=")) for x in names) if n < before)

    def _read(self, kind: str, loads: list[int]) -> DataFrame:
        paths = [f"{self.root}/{kind}/{LOAD}={n}" for n in loads]
        return self.spark.read.option("basePath", f"{self.root}/{kind}").parquet(*paths)

    def states(self, before: int = 2**31 - 1) -> DataFrame:
        """The newest state of every symbol and year, from the finished loads before a number."""
        loads = self._finished(before)
        if not loads:
            raise FileNotFoundError(f"no finished load in {self.root}")
        every = self._read("states", loads)
        columns = [c for c in every.columns if c != LOAD]
        if len(loads) == 1:
            return every.select(columns)
        rest = [c for c in columns if c not in GROUP]
        newest = every.groupBy(*GROUP).agg(F.max_by(F.struct(*rest), LOAD).alias("s"))
        return newest.select(*GROUP, "s.*")

    def bars(self, loads: list[int] | None = None, groups: DataFrame | None = None) -> DataFrame:
        """The bars as they are now: those of a symbol and day come from the newest load that has any.

        ``groups`` names the symbols and years that are read.
        """
        every = self._read("bars", self._finished(2**31 - 1) if loads is None else loads)
        if groups is not None:
            every = every.join(groups, GROUP, "left_semi")
        key = ["symbol", "trade_date"]
        newest = every.groupBy(*key).agg(F.max(LOAD).alias("_newest"))
        met = every.join(newest, key).where(F.col(LOAD) == F.col("_newest"))
        return met.drop(LOAD, "_newest")

    def apply(self, bars: DataFrame, load: int) -> None:
        """Writes one load and merges it into the states; to be repeated under the same number after a failure.

        Bars without a symbol or day are refused: they belong to no state.
        """
        nowhere = F.col("symbol").isNull() | F.col("trade_date").isNull()
        refused = F.raise_error(F.lit("a bar without a symbol or a day")).cast("int")
        year = F.when(nowhere, refused).otherwise(F.year("trade_date"))
        ordered = bars.withColumn(YEAR, year).repartitionByRange(YEAR, "symbol", "trade_date").sortWithinPartitions(YEAR, "symbol", "trade_date")
        ordered.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(YEAR).parquet(f"{self.root}/bars/{LOAD}={load}")

        earlier = self._finished(load)
        schema = T.StructType([*bars.schema.fields, T.StructField(YEAR, T.IntegerType())])
        written = self.spark.read.schema(schema).parquet(f"{self.root}/bars/{LOAD}={load}")
        new = settle(states(written), "bar-states")
        changed = new
        if earlier:
            old = self.states(load).join(new.select(*GROUP), GROUP, "left_semi")
            met = new.alias("new").join(old.alias("old"), GROUP, "left")
            # both bitmaps have a bit in common where the load has days that are stored already
            common = reduce(Column.__or__, [F.coalesce(F.col(f"new.{c}").bitwiseAND(F.col(f"old.{c}")), F.lit(0)) != 0 for c in _DAYS])
            rest = [c for c in new.columns if c not in GROUP]
            sides = [F.struct(*[F.col(f"{x}.{c}") for c in rest]).alias(x) for x in ("new", "old")]
            met = settle(met.select(*GROUP, common.alias("corrects"), *sides), "bar-merge")
            merged = met.where("not corrects").select(*GROUP, *_merged("old", "new"))
            again = met.where("corrects").select(*GROUP)
            # only the groups with corrected days are computed anew
            changed = merged.unionByName(states(self.bars([*earlier, load], again)))
        changed.write.mode("overwrite").parquet(f"{self.root}/states/{LOAD}={load}")
        self.spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/done/{LOAD}={load}")

    def compact(self, load: int) -> None:
        """Writes all states as they are after a finished load into that load's folder, so that readers need no other."""
        path = f"{self.root}/states/{LOAD}={load}"
        whole = settle(self.states(load + 1), "bar-states")
        whole.write.mode("overwrite").parquet(path)
