"""Price guard on a stream of changes.

State is a base table plus one small folder of price deltas per micro-batch, so
a batch writes only the prices it changed, never the whole table. Both are
partitioned by a hash bucket of the key, and a batch reads only its own
buckets; the deltas are folded into a new base every few batches. A batch reads
deltas of earlier batches only and overwrites its own folders, so running it
again, after a lost executor or a restart, gives the same files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tablewarden.operators.audit import KEY, PriceGuard, audit_log
from tablewarden.schemas import AUDIT_LOG

CHANGE_SCHEMA = f"seq long, islem_zamani timestamp, role string, {KEY} long, new_adr decimal(10,2)"
_DELTA = f"{KEY} long, adr decimal(10,2)"
# Above this many distinct keys a micro-batch is joined by shuffle.
BROADCAST_KEYS = 500_000
BUCKETS = 64
BUCKET = "bucket"
# Batches between two compactions of a stream.
COMPACT_EVERY = 50


class PriceStore:
    """Prices and audit rows under one folder.

    ``base/batch=n/bucket=b``    full table with the changes of batches up to n
    ``bases/batch=n``   one row per finished base
    ``deltas/base=n/batch=m/bucket=b``  prices changed by batch m, since base n
    ``audit/batch=m``   audit rows of batch m
    """

    def __init__(self, spark: SparkSession, root: str, broadcast_keys: int = BROADCAST_KEYS, buckets: int = BUCKETS):
        self.spark, self.root, self.broadcast_keys, self.buckets = spark, root.rstrip("/"), broadcast_keys, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(KEY), F.lit(self.buckets)).cast("int")

    def _write_base(self, base: DataFrame, number: int) -> None:
        ordered = base.withColumn(BUCKET, self._bucket()).repartitionByRange(BUCKET, KEY).sortWithinPartitions(BUCKET, KEY)
        ordered.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.root}/base/batch={number}")
        nothing = self.spark.createDataFrame([], _DELTA)
        nothing.write.mode("overwrite").parquet(f"{self.root}/deltas/base={number}/batch={number}/{BUCKET}=0")
        self.spark.range(1).write.mode("overwrite").parquet(f"{self.root}/bases/batch={number}")

    def start(self, base: DataFrame) -> None:
        """Write the first base table."""
        self.spark.createDataFrame([], AUDIT_LOG).write.mode("overwrite").parquet(f"{self.root}/audit/batch=-1")
        self._write_base(base, -1)

    def _newest_base(self, before: int) -> int:
        # one tiny file per compaction
        bases = self.spark.read.schema("id long, batch long").parquet(f"{self.root}/bases")
        return bases.where(F.col("batch") < before).agg(F.max("batch")).first()[0]

    def _deltas(self, number: int, before: int) -> DataFrame:
        folder = f"{self.root}/deltas/base={number}"
        return self.spark.read.schema(f"{_DELTA}, batch long, {BUCKET} int").parquet(folder).where(F.col("batch") < before)

    def prices(self, before: int = 2**62, keys: DataFrame | None = None, buckets: list[int] | None = None) -> DataFrame:
        """Rows as they were before a batch, for all keys or the given ones, read from the given buckets.

        The newest delta of a key wins; deltas are reduced per key before the join.
        """
        number = self._newest_base(before)
        base = self.spark.read.parquet(f"{self.root}/base/batch={number}")
        changed = self._deltas(number, before)
        columns = [c for c in base.columns if c != BUCKET]
        if buckets is not None:
            base, changed = base.where(F.col(BUCKET).isin(buckets)), changed.where(F.col(BUCKET).isin(buckets))
        if keys is not None:
            base, changed = base.join(keys, KEY, "left_semi"), changed.join(keys, KEY, "left_semi")
        newest = changed.groupBy(KEY).agg(F.max_by("adr", "batch").alias("_adr"), F.max("batch").alias("_batch"))
        adr = F.when(F.col("_batch").isNotNull(), F.col("_adr")).otherwise(F.col("adr"))
        return base.join(newest, KEY, "left").withColumn("adr", adr).select(*columns)

    def compact(self, last: int) -> None:
        """Fold the deltas of batches up to ``last`` into a new base."""
        if last > self._newest_base(2**62):
            self._write_base(self.prices(before=last + 1), last)
            self._forget(last)

    def _forget(self, last: int) -> None:
        """Removes bases older than the two newest, with their deltas."""
        bases = self.spark.read.schema("id long, batch long").parquet(f"{self.root}/bases").select("batch")
        old = [r.batch for r in bases.distinct().orderBy(F.desc("batch")).collect()[2:]]
        hadoop = self.spark.sparkContext._jsc.hadoopConfiguration()
        for n in old:
            for folder in (f"bases/batch={n}", f"base/batch={n}", f"deltas/base={n}"):
                path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}")
                path.getFileSystem(hadoop).delete(path, True)

    def apply(self, changes: DataFrame, batch: int, guard: PriceGuard) -> None:
        """Decide one micro-batch and write its audit rows and its deltas."""
        changes = changes.persist()
        keys = changes.select(KEY).where(F.col(KEY).isNotNull()).distinct().persist()
        # a small key set goes to the base rows; the base is then not shuffled
        small = keys.count() <= self.broadcast_keys
        # at most one number for each bucket
        buckets = [r[0] for r in keys.select(self._bucket()).distinct().collect()]
        met = self.prices(batch, F.broadcast(keys) if small else keys, buckets).persist()
        try:
            log = audit_log(guard.decide(changes, met))
            log.select(*AUDIT_LOG.fieldNames()).write.mode("overwrite").parquet(f"{self.root}/audit/batch={batch}")
            deltas = f"{self.root}/deltas/base={self._newest_base(batch)}/batch={batch}"
            changed = guard.price_deltas(changes, met).withColumn(BUCKET, self._bucket())
            changed.write.mode("overwrite").partitionBy(BUCKET).parquet(deltas)
        finally:
            for df in (met, keys, changes):
                df.unpersist()

    def audit(self) -> DataFrame:
        """Audit rows of all batches, with the batch number."""
        return self.spark.read.schema(T.StructType([*AUDIT_LOG.fields, T.StructField("batch", T.LongType())])).parquet(f"{self.root}/audit")


def without_repeats(changes: DataFrame, delay: str) -> DataFrame:
    """Drop a change delivered twice within ``delay``."""
    return changes.withWatermark("islem_zamani", delay).dropDuplicatesWithinWatermark(["seq"])


def guard_stream(
    changes: DataFrame,
    store: PriceStore,
    guard: PriceGuard,
    checkpoint: str,
    compact_every: int = COMPACT_EVERY,
    **trigger,
) -> StreamingQuery:
    """Run the guard on a stream. Changes apply in batch order, then by ``seq``.

    After every ``compact_every`` batches the deltas go into a new base, so a
    batch reads the deltas of at most that many.
    """

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        store.apply(batch, batch_id, guard)
        if (batch_id + 1) % compact_every == 0:
            store.compact(batch_id)

    return (
        changes.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
