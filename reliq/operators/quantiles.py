"""Exact median of a column of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """One row with the interpolated ``median``; null is ignored, and is the median of nothing.

    Distinct values are counted and dealt into ranges. The totals of the ranges tell where each
    begins, and values are ranked inside those ranges only that hold a middle place: one plan, in
    which no task sees more than a range.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter("v is not null")
    counted = values.groupBy("v").agg(F.count("*").alias("n")).repartitionByRange("v")
    ranged = counted.withColumn("range", F.spark_partition_id())
    totals = ranged.groupBy("range").agg(F.sum("n").alias("size"), F.min("v").alias("low"), F.max("v").alias("high"))
    # One row per range from here on.
    placed = totals.withColumn("before", F.sum("size").over(Window.orderBy("low")) - F.col("size")).withColumn(
        "all", F.sum("size").over(Window.partitionBy())
    )
    low, high = F.expr("(all - 1) div 2"), F.expr("all div 2")

    def holds(place, before, size):
        return (before <= place) & (place < before + size)

    middle = placed.filter(
        holds(low, F.col("before"), F.col("size")) | holds(high, F.col("before"), F.col("size"))
    ).select("low", "high", "before", "all")
    # Ranges are told by their ends, so a value meets its range also where it is counted anew.
    near = counted.join(F.broadcast(middle), (F.col("v") >= F.col("low")) & (F.col("v") <= F.col("high")))
    inside = Window.partitionBy("before").orderBy("v")
    ranked = near.withColumn("first", F.col("before") + F.sum("n").over(inside) - F.col("n"))
    at_low = F.max(F.when(holds(low, F.col("first"), F.col("n")), F.col("v")))
    at_high = F.max(F.when(holds(high, F.col("first"), F.col("n")), F.col("v")))
    return ranked.agg(((at_low + at_high) / 2).alias("median"))
