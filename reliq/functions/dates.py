"""Calendar parts in the conventions of the date dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: day and month names are padded to the longest English one.
NAME_WIDTH = 9


def weekday_from_sunday(day: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(day) - 1


def padded_day_name(day: Column) -> Column:
    return F.rpad(F.date_format(day, "EEEE"), NAME_WIDTH, " ")


def padded_month_name(day: Column) -> Column:
    return F.rpad(F.date_format(day, "MMMM"), NAME_WIDTH, " ")


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds, rounded to hundredths."""
    micros = (F.unix_micros(end) - F.unix_micros(start)).cast("decimal(20,0)")
    return (micros / F.lit(1_000_000)).cast("decimal(10,2)")
