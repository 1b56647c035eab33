"""Places of rows within their groups, found without one task per group."""

from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reliq.llm.text import stored


def ranked(df: DataFrame, group: str, order: list[str], purpose: str) -> DataFrame:
    """The rows with ``place`` (from 0 on, in ``order``, nulls first), ``size`` of their group, ``part`` and ``seq``.

    ``df`` is a stored frame in which ``group`` and ``order`` together tell all rows apart and
    ``group`` is never null. Rows are dealt by ranges of group and order, so a group lies in as
    many tasks as it needs; what crosses tasks is one count per group and task. ``part`` is the
    range of a row, and ``seq`` ascends with the place within it.
    """
    keys = [F.asc_nulls_first(name) for name in (group, *order)]
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    rows = stored(dealt.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("seq")), purpose)
    pieces = rows.groupBy(group, "part").agg(F.min("seq").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy(group)
    earlier = F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = pieces.select(
        group,
        "part",
        (F.col("first") - F.coalesce(earlier, F.lit(0))).alias("shift"),
        F.sum("n").over(whole).alias("size"),
    )
    return rows.join(shifts, [group, "part"]).withColumn("place", F.col("seq") - F.col("shift")).drop("shift")


