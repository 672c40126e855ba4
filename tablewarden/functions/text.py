"""Checks and conversions of text fields. Each gives null for what it refuses."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewarden.schemas import NULL_WORDS


def null_words(value: Column, words: Iterable[str] = NULL_WORDS) -> Column:
    """The value, or null for one of the given words."""
    return F.when(~value.isin(*words), value)


def as_int(value: Column) -> Column:
    # an empty text is caught here, because a failing cast costs far more
    return F.nullif(value, F.lit("")).try_cast("int")


# checked before a cast, because a failing cast costs far more than a match
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def as_number(value: Column, precision: int, scale: int) -> Column:
    """Rounded half away from zero to the scale; null when it does not fit."""
    return F.when(value.rlike(_NUMBER), value.try_cast(f"decimal({precision},{scale})"))


def as_date(value: Column) -> Column:
    """yyyy-mm-dd only; a bare year or a day that does not exist gives null."""
    return F.when(value.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"), value.try_cast("date"))


def cut(value: Column, length: int) -> Column:
    return F.left(value, F.lit(length))


def too_long(value: Column, length: int) -> Column:
    """Whether anything but blanks is beyond the length."""
    return F.length(F.rtrim(value)) > length


def fitted(value: Column, length: int) -> Column:
    """The text if it fits; blanks beyond the length are cut, more gives null."""
    return F.when(~too_long(value, length), cut(value, length))


def number_fault(value: Column, precision: int, scale: int) -> Column:
    """Why a text is no decimal(precision, scale); null when it is one."""
    return F.when(~value.rlike(_NUMBER), "not a number").when(
        value.isNotNull() & value.try_cast(f"decimal({precision},{scale})").isNull(), "out of range"
    )
