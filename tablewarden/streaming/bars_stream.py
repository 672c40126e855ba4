"""Bar files arriving in a directory: checked, then appended by year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tablewarden.functions.text import as_date, fitted
from tablewarden.operators.constraints import outside_years, with_faults
from tablewarden.operators.derived import next_id, with_bar_columns, with_load_time, with_surrogate_id
from tablewarden.schemas import BAR_YEARS, BARS
from tablewarden.sources.bars_csv import raw_lines
from tablewarden.sources.bookings import QUOTES, open_quote
from tablewarden.sources.layout import YEAR


def _value(field: T.StructField) -> Column:
    text = F.col(field.name)
    if isinstance(field.dataType, T.DateType):
        return as_date(text)
    if isinstance(field.dataType, T.StringType):
        return fitted(text, field.metadata["max_length"])
    return text.try_cast(field.dataType)


def read_stream(spark: SparkSession, path: str, years: tuple[int, int] = BAR_YEARS) -> DataFrame:
    """Typed bars with ``faults``; the line of a faulty row is kept in ``raw``."""
    lines = raw_lines(spark.readStream, path)
    fields = F.from_csv(F.when(~open_quote(F.col("line")), F.col("line")), ", ".join(f"{f.name} string" for f in BARS.fields), QUOTES)
    rows = lines.select("line", fields.alias("f")).select("line", "f.*")
    rules = {f"{f.name}: missing or malformed": _value(f).isNull() for f in BARS.fields}
    day = as_date(F.col("trade_date"))
    rules["trade_date: no partition"] = day.isNotNull() & outside_years(day, *years)
    marked = with_faults(rows, rules)
    raw = F.when(F.size("faults") > 0, F.col("line"))
    return marked.select(*[_value(f).alias(f.name) for f in BARS.fields], "faults", raw.alias("raw"))


def write_batch(batch: DataFrame, number: int, out: str, rejects: str) -> None:
    """Write one micro-batch into its own folders, good bars by year and rejected rows.

    Both writes use the batch that was read once. Writing a batch again
    replaces its folders and gives the same rows; ids go on after those of
    earlier batches.
    """
    batch = batch.persist()
    try:
        good = with_bar_columns(batch.where(F.size("faults") == 0).drop("faults", "raw")).withColumn(YEAR, F.year("trade_date"))
        stored = next_id(batch.sparkSession, out, before_batch=number)
        clustered = good.repartitionByRange(YEAR, "symbol", "trade_date").sortWithinPartitions(YEAR, "symbol", "trade_date")
        rows = with_load_time(with_surrogate_id(clustered, start=stored))
        rows.write.mode("overwrite").partitionBy(YEAR).parquet(f"{out}/batch={number}")
        bad = batch.where(F.size("faults") > 0).select("raw", F.array_join("faults", "; ").alias("reason"))
        bad.write.mode("overwrite").parquet(f"{rejects}/batch={number}")
    finally:
        batch.unpersist()


def start(rows: DataFrame, out: str, rejects: str, checkpoint: str, **trigger) -> list[StreamingQuery]:
    """One query that writes both outputs, each batch exactly once."""
    query = (
        rows.writeStream.foreachBatch(lambda batch, number: write_batch(batch, number, out, rejects))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    return [query]


def streamed_bars(spark: SparkSession, out: str) -> DataFrame:
    """What the stream has written, with the columns of a batch load."""
    return spark.read.parquet(out).drop("batch", YEAR)
