"""Moving means kept up to date while bars arrive, late ones included.

``means/batch=<n>``  rows whose means batch n has added or changed
``tails/batch=<n>``  the last rows of each symbol that batch n has touched
``done/batch=<n>``   one row for each finished batch

A bar changes the means of its own row and of the rows after it that still
reach back to it. Bars behind all stored ones need only the tail of their
symbol. Where a symbol has late bars, the rows from the first to the last of
them are read, with as many before and after as the widest mean spans; no other
row is computed anew. A batch reads what earlier batches have written and
overwrites its own folders, so running it again gives the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablewarden.operators.ordered import moving_means, settle
from tablewarden.plans.bars import SPANS
from tablewarden.session import ROWS_PER_TASK

KEY = ["symbol", "trade_date"]
ROW = "symbol string, trade_date date, close_price decimal(12,4)"
BATCH = "batch"


class MeansStore:
    """Closing prices and their moving means below one folder; one bar for a symbol and day, the newest."""

    def __init__(self, spark: SparkSession, root: str, spans: Mapping[str, int] = SPANS, rows_per_task: int = ROWS_PER_TASK):
        self.spark, self.root, self.spans, self.rows_per_task = spark, root.rstrip("/"), dict(spans), rows_per_task
        self.reach = max(self.spans.values()) - 1

    def _finished(self, before: int) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/done")
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(n for n in (int(x.removeprefix(f"{BATCH}=")) for x in names) if n < before)

    def _read(self, kind: str, columns: str, before: int) -> DataFrame:
        paths = [f"{self.root}/{kind}/{BATCH}={n}" for n in self._finished(before)]
        schema = f"{columns}, {BATCH} int"
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{kind}").parquet(*paths)

    def means(self, before: int = 2**31 - 1) -> DataFrame:
        """Every bar with its means, as of the finished batches before a number."""
        names = [f"{n} decimal(18,4)" for n in self.spans]
        every = self._read("means", ", ".join([ROW, *names]), before)
        rest = ["close_price", *self.spans]
        return every.groupBy(*KEY).agg(F.max_by(F.struct(*rest), BATCH).alias("r")).select(*KEY, "r.*")

    def _tails(self, before: int) -> DataFrame:
        """The last rows of each symbol, from the newest batch that touched it."""
        every = self._read("tails", ROW, before)
        newest = every.groupBy("symbol").agg(F.max(BATCH).alias("newest"))
        return every.join(newest, "symbol").where(F.col(BATCH) == F.col("newest")).select(*KEY, "close_price")

    def _nearest(self, rows: DataFrame, descending: bool) -> DataFrame:
        """The rows of each symbol next to its late bars; Catalyst limits each task before the shuffle."""
        day = F.col("trade_date")
        place = F.row_number().over(W.partitionBy("symbol").orderBy(day.desc() if descending else day.asc()))
        return rows.withColumn("_place", place).where(F.col("_place") <= self.reach).drop("_place")

    def _around(self, span: DataFrame, late: DataFrame, number: int) -> DataFrame:
        """Stored rows that the symbols with late bars need: their days, and those just before and after."""
        spans = span.join(late, "symbol", "left_semi")
        stored = self.means(number).select(*KEY, "close_price").join(spans, "symbol")
        columns = [*KEY, "close_price"]
        within = stored.where(F.col("trade_date").between(F.col("first"), F.col("last"))).select(columns)
        before = self._nearest(stored.where(F.col("trade_date") < F.col("first")).select(columns), True)
        after = self._nearest(stored.where(F.col("trade_date") > F.col("last")).select(columns), False)
        return within.unionAll(before).unionAll(after)

    def apply(self, bars: DataFrame, number: int) -> None:
        """Takes one batch of bars; of several for one symbol and day the highest close stays.

        Bars without a symbol or day are refused.
        """
        nowhere = F.col("symbol").isNull() | F.col("trade_date").isNull()
        refused = F.raise_error(F.lit("a bar without a symbol or a day")).cast("date")
        day = F.when(nowhere, refused).otherwise(F.col("trade_date")).alias("trade_date")
        new = bars.select("symbol", day, F.col("close_price").cast("decimal(12,4)").alias("close_price"))
        new = settle(new.groupBy(*KEY).agg(F.max("close_price").alias("close_price")), "mean-batch")
        span = new.groupBy("symbol").agg(F.min("trade_date").alias("first"), F.max("trade_date").alias("last"))
        span = settle(span, "mean-spans")
        tails = settle(self._tails(number).join(span.select("symbol"), "symbol", "left_semi"), "mean-tails")
        ends = tails.groupBy("symbol").agg(F.max("trade_date").alias("end"))
        late = settle(span.join(ends, "symbol").where(F.col("first") <= F.col("end")).select("symbol"), "late-symbols")

        context = tails.join(late, "symbol", "left_anti").unionByName(self._around(span, late, number))
        # a bar of a stored day takes that day's place
        rows = context.join(new.select(*KEY), KEY, "left_anti").unionByName(new)
        means = moving_means(rows, self.spans, rows_per_task=self.rows_per_task)
        touched = means.join(span.select("symbol", "first"), "symbol").where(F.col("trade_date") >= F.col("first"))
        names = [F.col(n).cast("decimal(18,4)").alias(n) for n in self.spans]
        touched.select(*KEY, "close_price", *names).write.mode("overwrite").parquet(f"{self.root}/means/{BATCH}={number}")

        kept = tails.join(new.select(*KEY), KEY, "left_anti").unionByName(new)
        self._nearest(kept, True).write.mode("overwrite").parquet(f"{self.root}/tails/{BATCH}={number}")
        self.spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/done/{BATCH}={number}")


def start(bars: DataFrame, store: MeansStore, checkpoint: str, **trigger) -> StreamingQuery:
    """Keeps the means of a stream of bars."""
    return (
        bars.writeStream.foreachBatch(lambda batch, number: store.apply(batch, number))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
