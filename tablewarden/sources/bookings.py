"""Lenient load of booking files: a bad row is kept aside with its reason."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.functions.text import as_date, as_int, as_number, cut, null_words, number_fault, too_long
from tablewarden.operators.derived import next_id, with_surrogate_id
from tablewarden.operators.serials import in_ranges
from tablewarden.schemas import BOOKING_COLUMNS, SENTINEL_COLUMNS

# a quote inside quotes is doubled; a backslash is a letter like any other
QUOTES = {"escape": '"'}
ROW, COUNT, _BAD, _MARK = "_row", "_n", "_bad", "\u0001"
GOOD, REJECTED = "good", "rejected"


def _split(line: Column, names: list[str]) -> Column:
    """A line as a struct of texts with one extra field after the last.

    A mark is put behind the line; its place tells how many fields there were.
    """
    schema = ", ".join(f"`{n}` string" for n in [*names, _MARK + "end"])
    return F.from_csv(F.concat(line, F.lit("," + _MARK)), schema, QUOTES)


def _count_fields(row: Column, names: list[str]) -> Column:
    place = F.array_position(F.array(*[row[n] for n in [*names, _MARK + "end"]]), _MARK)
    return F.when(place > 0, place - 1).otherwise(len(names)).cast("int")


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row.

    It comes from a generator, so the optimizer does not copy the expression
    into every later use of the column, and each one is compiled on its own.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def _present(name: str, place: int) -> Column:
    """The reader gives null for both an empty and an absent field; tell them apart."""
    return F.when(F.col(COUNT) > place, F.coalesce(F.col(ROW)[name], F.lit("")))


def open_quote(line: Column) -> Column:
    """Whether a line has an odd number of quotes, so that a quoted text goes on beyond it."""
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1


def read_strings(
    spark: SparkSession, path: str | list[str], multi_line: bool = False, in_order: bool = False
) -> DataFrame:
    """Rows as a struct of texts in table order, and the number of fields present.

    Columns are matched by header name. Only the header is read for the names;
    no pass infers types. With ``multi_line`` a quoted text may hold line
    breaks, but then a file is read by one task; without it a line that ends
    within a quoted text has no fields and becomes a reject. With ``in_order``
    the rows are dealt out in sorted ranges of file name and line; lines are
    ordered before they are parsed, so that they are parsed once.
    """
    if multi_line and in_order:
        raise ValueError("records over several lines have no order of lines")
    names = spark.read.options(header=True, multiLine=multi_line, **QUOTES).csv(path).columns
    missing = [c for c in BOOKING_COLUMNS if c not in names]
    if missing:
        raise ValueError(f"columns missing in the file: {', '.join(missing)}")
    rows = _whole_records(spark, path, names) if multi_line else _lines(spark, path, names, in_order)
    if names[: len(BOOKING_COLUMNS)] == list(BOOKING_COLUMNS):
        return rows
    # another column order: settle absent fields here
    by_name = F.struct(*[_present(c, names.index(c)).alias(c) for c in BOOKING_COLUMNS])
    return rows.select(by_name.alias(ROW), F.lit(len(names)).alias(COUNT))


def _whole_records(spark: SparkSession, path: str | list[str], names: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _BAD]])
    # every file must have the same header; one with another order stops the load
    options = {"header": True, "enforceSchema": False, "columnNameOfCorruptRecord": _BAD, "multiLine": True}
    rows = spark.read.schema(schema).options(**options, **QUOTES).csv(path)
    # only records with a wrong number of fields are parsed a second time
    recounted = F.transform(F.array(_split(F.col(_BAD), names)), lambda row: _count_fields(row, names))[0]
    count = F.when(F.col(_BAD).isNull(), len(names)).otherwise(recounted)
    return _once(rows.select(F.struct(*names).alias(ROW), count.alias("_c")), COUNT, F.col("_c")).drop("_c")


def _lines(spark: SparkSession, path: str | list[str], names: list[str], in_order: bool = False) -> DataFrame:
    """Every line but the headers; a header with the same names in another order stops the load."""
    lines = spark.read.text(path).where("value <> ''")
    if in_order:
        # a split of a file is read from front to back, so ids that rise along the scan order its lines
        lines = in_ranges(lines, [F.col("_metadata.file_path"), F.col("_metadata.file_block_start")])
    rows = strings_from_lines(lines, "value", names)
    first = F.col(ROW)[names[0]]
    texts = F.array(*[F.col(ROW)[n] for n in names])
    wanted = F.array(*[F.lit(n) for n in names])
    # only a line whose first field is a column name can be a header
    is_name = first.isin(*names)
    # sort_array is compiled, array_sort is not
    other = is_name & (texts != wanted) & (F.sort_array(texts) == F.sort_array(wanted))
    stop = F.raise_error(F.lit("a file has its header in another order")).cast("boolean")
    header = F.when(other, stop).otherwise(F.coalesce(is_name & (texts == wanted), F.lit(False)))
    # as a column of its own the filter stays a plain one
    return _once(rows, "_header", header).where(~F.col("_header")).drop("_header")


def strings_from_lines(lines: DataFrame, line: str = "line", names: list[str] | None = None) -> DataFrame:
    """The same from a column of lines, by default in table order; other columns are kept."""
    names = names or list(BOOKING_COLUMNS)
    marked = lines.withColumn("_open", open_quote(F.col(line)))
    rows = _once(marked, ROW, _split(F.when(~F.col("_open"), F.col(line)), names)).drop(line)
    whole = F.col(ROW)[_MARK + "end"] == _MARK
    # the last branch is reached by lines with another number of fields only
    count = F.when(F.col("_open"), 0).when(whole, len(names)).otherwise(_count_fields(F.col(ROW), names))
    return _once(rows, COUNT, count).drop("_open")


def _parts(kind: str) -> tuple[str, list[int]]:
    name, *rest = re.findall(r"\w+", kind)
    return name, [int(r) for r in rest]


def typed(strings: DataFrame) -> DataFrame:
    """Typed columns and ``reason``: null for a good row, else its first fault.

    An absent or empty whole number is a fault. An empty text stays empty, an
    absent one is null. The null words count only in the sentinel columns.
    Faults of parsing come before faults of fitting, each in column order.

    The row travels as one struct and each kind of column is converted by its
    own generator, which keeps every compiled method small enough for the JIT.
    """
    values: dict[str, list[Column]] = {"int": [], "text": [], "number": [], "date": []}
    parsing, fitting, too_long_texts, columns = [], [], [], []
    for place, (name, kind) in enumerate(BOOKING_COLUMNS.items()):
        sort, size = _parts(kind)
        # a sentinel column has null for both, and so has a whole number
        absent_is_empty = name in SENTINEL_COLUMNS or sort == "int"
        text = null_words(F.col(ROW)[name]) if absent_is_empty else _present(name, place)
        value = F.col(f"_{sort}")[name]
        columns.append(value.alias(name))
        if sort == "int":
            values[sort].append(as_int(F.col(ROW)[name]).alias(name))
            parsing.append(F.when(value.isNull(), f"{name}: not an integer"))
        elif sort == "number":
            fault = F.col(f"_{sort}")[f"{name}_fault"]
            values[sort] += [as_number(text, *size).alias(name), number_fault(text, *size).alias(f"{name}_fault")]
            if name in SENTINEL_COLUMNS:
                fitting.append(F.when(fault == "not a number", f"{name}: not a number"))
            else:
                no_number = (fault == "not a number") | (value.isNull() & fault.isNull())
                parsing.append(F.when(no_number, f"{name}: not a number"))
            fitting.append(F.when(fault == "out of range", f"{name}: out of range"))
        elif sort == "date":
            values[sort] += [as_date(text).alias(name), text.isNotNull().alias(f"{name}_given")]
            given = F.col(f"_{sort}")[f"{name}_given"]
            fitting.append(F.when(given & value.isNull(), f"{name}: not a date"))
        else:
            values[sort].append(cut(text, *size).alias(name))
            too_long_texts.append(F.when(too_long(text, *size), f"{name}: too long"))
    rows = strings
    for sort, converted in values.items():
        rows = _once(rows, f"_{sort}", F.struct(*converted))
    rows = _once(rows, "_long", F.coalesce(*too_long_texts))
    kept = [c for c in strings.columns if c not in (ROW, COUNT)]
    reason = F.coalesce(*parsing, F.col("_long"), *fitting)
    return rows.select(*kept, *columns, reason.alias("reason"))


def possible_reasons() -> list[str]:
    """Every reason that ``typed`` can give, in the order of the columns."""
    kinds = {"int": ["not an integer"], "text": ["too long"], "number": ["not a number", "out of range"], "date": ["not a date"]}
    return [f"{name}: {fault}" for name, kind in BOOKING_COLUMNS.items() for fault in kinds[_parts(kind)[0]]]


def load(
    spark: SparkSession, path: str | list[str], out: str, mode: str = "overwrite", multi_line: bool = False
) -> dict[str, int]:
    """Read, type and write files in one pass, good and rejected rows in their own folders.

    Returns the rows by outcome, ``good`` and each reason that occurred, counted
    while they were written; nothing is read again for it.

    The id is given here and stored, so every later step sees the same one. An
    appended load goes on after the largest id that is stored; two loads into
    one folder must not run at the same time.
    """
    start = next_id(spark, out) if mode == "append" else 0
    rows = with_surrogate_id(typed(read_strings(spark, path, multi_line)), start=start)
    status = F.when(F.col("reason").isNull(), GOOD).otherwise(REJECTED)
    seen = Observation()
    # one sketch with room for every outcome, which makes its counts exact; an aggregate for each is not compiled and costs more than the load
    outcomes = len(possible_reasons()) + 1
    counted = F.expr(f"approx_top_k(coalesce(reason, '{GOOD}'), {outcomes}, {2 * outcomes})")
    rows = rows.observe(seen, counted.alias("outcomes"))
    writer = rows.withColumn("status", status).write.mode(mode).partitionBy("status")
    # an overwrite replaces both folders, also when one gets no rows
    writer.option("partitionOverwriteMode", "static").parquet(out)
    return {outcome["item"]: outcome["count"] for outcome in seen.get["outcomes"] or []}


def good(loaded: DataFrame) -> DataFrame:
    return loaded.where(F.col("status") == GOOD).drop("status", "reason")


def rejected(loaded: DataFrame) -> DataFrame:
    return loaded.where(F.col("status") == REJECTED).drop("status")


def load_counts(loaded: DataFrame) -> DataFrame:
    """Rows written per status, counted from what was written."""
    return loaded.groupBy("status").count()


def reject_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reason").agg(F.count("*").alias("hata_sayisi")).orderBy("reason")


def first_rejects(rejects: DataFrame, rows: int = 5) -> DataFrame:
    return rejects.select("id", "reason").orderBy("id").limit(rows)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
