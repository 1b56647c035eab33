"""Audit logs: rows appended by run day, read by day, and compacted.

A log is a folder per day on which runs started. Appends are tiny files; a day with many of them is
rewritten as one. Each row has an identity of its own, so between the new file and the removal of the
old ones no row counts twice, and a compaction that ends in between loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reliq.sinks.versions import files_of, names_in

#: Files of one day beyond which they are rewritten as one.
MOST_FILES = 32
DAY, ENTRY = "run_day", "entry"


def append_log(df: DataFrame, path: str, schema: T.StructType, day: date) -> None:
    """Append a few rows in the declared layout to the log of a day."""
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    rows = df.select(*columns, F.uuid().alias(ENTRY))
    rows.coalesce(1).write.mode("append").parquet(f"{path}/{DAY}={day:%Y-%m-%d}")


def log_days(spark: SparkSession, path: str) -> list[date]:
    """The days of a log, newest first."""
    names = names_in(spark, f"{path}/{DAY}=*")
    return [date.fromisoformat(name.rsplit("=", 1)[1]) for name in reversed(names)]


def read_log(spark: SparkSession, path: str, schema: T.StructType, days: Sequence[date] | None = None) -> DataFrame:
    """The rows of a log, of all days or some of them; no other folders are read."""
    if not log_days(spark, path):
        return spark.createDataFrame([], schema)
    layout = T.StructType([*schema.fields, T.StructField(ENTRY, T.StringType()), T.StructField(DAY, T.DateType())])
    rows = spark.read.schema(layout).parquet(path)
    if days is not None:
        rows = rows.filter(F.col(DAY).isin(list(days)))
    return rows.dropDuplicates([ENTRY]).select(*schema.names)


def read_newest(
    spark: SparkSession, path: str, schema: T.StructType, enough: Callable[[DataFrame], bool], first: int = 2
) -> DataFrame:
    """The rows of the newest days that together hold enough, or of all days."""
    days, taken = log_days(spark, path), first
    while True:
        rows = read_log(spark, path, schema, days[:taken])
        if taken >= len(days) or enough(rows):
            return rows
        taken *= 2


def log_files(spark: SparkSession, path: str, day: date) -> list[str]:
    return names_in(spark, f"{path}/{DAY}={day:%Y-%m-%d}/part-*")


def compact_day(spark: SparkSession, path: str, schema: T.StructType, day: date, most: int = MOST_FILES) -> bool:
    """Rewrite a day of more than ``most`` files as one; whether it was."""
    old = log_files(spark, path, day)
    if len(old) <= most:
        return False
    layout = T.StructType([*schema.fields, T.StructField(ENTRY, T.StringType())])
    rows = spark.read.schema(layout).parquet(*old).dropDuplicates([ENTRY])
    rows.coalesce(1).write.mode("append").parquet(f"{path}/{DAY}={day:%Y-%m-%d}")
    for name in old:
        files, place = files_of(spark, name)
        files.delete(place, False)
    return True
