"""Top-k reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of a total order: every task keeps its own, the last one merges them."""
    return df.orderBy(*order).limit(n)


def cutoff_day(days: DataFrame, n: int):
    """The day from which on the daily metrics count at least ``n`` rows; None where all days are needed."""
    # One row per calendar day.
    reached = F.sum("total_transactions").over(Window.orderBy(F.desc_nulls_last("metric_date")))
    enough = days.withColumn("_reached", reached).filter((F.col("_reached") >= n) & F.col("metric_date").isNotNull())
    return enough.agg(F.max("metric_date")).head()[0]


def newest_days(df: DataFrame, day: str, n: int) -> DataFrame:
    """The rows of the newest days that together hold at least ``n`` rows, whatever ``n`` is.

    Rows are counted per day; the cutoff day is found among the days, and only rows from it on
    go further.
    """
    counts = df.groupBy(day).agg(F.count("*").alias("_rows"))
    # One row per calendar day.
    reached = F.sum("_rows").over(Window.orderBy(F.desc_nulls_last(day)))
    enough = counts.withColumn("_reached", reached).filter(F.col("_reached") - F.col("_rows") < n)
    cutoff = enough.agg(F.min(day).alias("_cutoff"), F.bool_or(F.col(day).isNull()).alias("_undated"))
    kept = df.join(F.broadcast(cutoff), (F.col(day) >= F.col("_cutoff")) | F.col("_undated"))
    return kept.drop("_cutoff", "_undated")
