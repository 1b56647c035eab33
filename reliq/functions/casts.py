"""Typing of landed text.

Strict casts raise on the first malformed value, which aborts the load.
Lenient casts give null, so that the row can be tagged instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reliq.schemas import DATE, EXACT, MONEY, TIMESTAMP


def typed(column: Column, kind, strict: bool = True) -> Column:
    return column.cast(kind) if strict else column.try_cast(kind)


def exact_amount(column: Column, strict: bool = True) -> Column:
    """The amount with all its digits, for comparisons."""
    return typed(F.trim(column), EXACT, strict)


def money(column: Column) -> Column:
    """The amount in cents, halves rounded away from zero."""
    return column.cast(MONEY)


def as_date(column: Column, strict: bool = True) -> Column:
    return typed(column, DATE, strict)


def as_timestamp(column: Column, strict: bool = True) -> Column:
    return typed(column, TIMESTAMP, strict)


def coerced_number(column: Column) -> Column:
    """A number, or null where the text is none; NaN counts as missing."""
    number = column.try_cast("double")
    return F.when(~F.isnan(number), number)


def required(column: Column, name: str) -> Column:
    """The column, raising where a value is missing."""
    message = F.lit(f"null value in required column {name}")
    return F.when(column.isNull(), F.raise_error(message)).otherwise(column)
