"""Strict load of bar files: the first bad row stops the load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.functions.text import as_date, fitted
from tablewarden.operators.derived import with_bar_columns, with_load_time, with_surrogate_id
from tablewarden.schemas import BARS
from tablewarden.sources.bookings import QUOTES, open_quote

_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in BARS.fields])


def _strict(field: T.StructField) -> Column:
    text = F.col(field.name)
    if isinstance(field.dataType, T.DateType):
        value = as_date(text)
    elif isinstance(field.dataType, T.StringType):
        value = fitted(text, field.metadata["max_length"])
    else:
        value = text.try_cast(field.dataType)
    problem = F.concat(F.lit(f"{field.name}: bad value "), F.coalesce(text, F.lit("(none)")))
    return F.coalesce(value, F.raise_error(problem).cast(field.dataType)).alias(field.name)


def strict_types(strings: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Typed bars; a missing, malformed or oversized value raises an error."""
    return strings.select(*(keep or []), *[_strict(f) for f in BARS.fields])


def raw_lines(reader, path: str | list[str]) -> DataFrame:
    """Lines of CSV files as they stand, without the header of each file; for readers and stream readers."""
    return reader.schema("line string").options(header=True, sep="\u0001", quote="", escape="").csv(path)


def read_bars(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Bars of CSV files with a header, in the fixed column order.

    A quoted text with line breaks needs ``multi_line``, which reads a file in
    one task; without it a line that ends within a quoted text stops the load.
    """
    if not multi_line:
        return bars_from_lines(raw_lines(spark.read, path))
    rows = spark.read.schema(_TEXT).options(header=True, mode="FAILFAST", multiLine=True, **QUOTES).csv(path)
    return with_bar_columns(strict_types(rows))


def bars_from_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """The same from a column of lines."""
    schema = ", ".join(f"{f.name} string" for f in BARS.fields)
    text = F.when(open_quote(F.col(line)), F.raise_error(F.lit("a line ends within a quoted text")).cast("string"))
    fields = F.from_csv(F.coalesce(text, F.col(line)), schema, {"mode": "FAILFAST", **QUOTES})
    return with_bar_columns(strict_types(lines.select(fields.alias("f")).select("f.*")))


def load(spark: SparkSession, path: str | list[str], out: str, at: Column | None = None) -> None:
    """Load files with id and load time added, replacing what was there."""
    with_load_time(with_surrogate_id(read_bars(spark, path)), at=at).write.mode("overwrite").parquet(out)
