"""Whole tables as numbered versions: a reader sees the last complete one.

A version is a folder below the table that Spark has marked as written. A write never touches
the version that readers use, so a failed one leaves the table as it was; the version before the
current one is kept for readers that have started on it, older ones are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

KEPT = 2


def files_of(spark: SparkSession, path: str):
    """The file system of a path, and the path in its terms."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def names_in(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a pattern, in order."""
    files, place = files_of(spark, pattern)
    return sorted(status.getPath().toString() for status in files.globStatus(place) or [])


def _numbers(spark: SparkSession, path: str, pattern: str) -> list[int]:
    found = names_in(spark, f"{path}/{pattern}")
    return sorted(int(name.split("/version-")[1].split("/")[0]) for name in found)


def version_path(path: str, number: int) -> str:
    return f"{path}/version-{number:012d}"


def complete_versions(spark: SparkSession, path: str) -> list[int]:
    return _numbers(spark, path, "version-*/_SUCCESS")


def current_path(spark: SparkSession, path: str) -> str | None:
    """The folder of the last complete version; None where there is none."""
    complete = complete_versions(spark, path)
    return version_path(path, complete[-1]) if complete else None


def write_version(df: DataFrame, path: str, partition_by: str | None = None, kept: int | None = KEPT) -> str:
    """Write a frame as the next version of a table and return its folder.

    The frame may read the current version. All but the last ``kept`` versions are deleted.
    """
    spark = df.sparkSession
    started = _numbers(spark, path, "version-*")
    number = started[-1] + 1 if started else 1
    target = version_path(path, number)
    # Tables are read more often than written, and are a good part of what a run writes.
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(target)
    if number not in complete_versions(spark, path):
        raise RuntimeError(f"{target} is not marked as written: the committer has to write _SUCCESS files")
    if kept is not None:
        drop_versions(spark, path, kept)
    return target


def drop_folder(spark: SparkSession, path: str) -> None:
    files, place = files_of(spark, path)
    files.delete(place, True)


def drop_versions(spark: SparkSession, path: str, kept: int) -> None:
    """Delete all versions before the last ``kept`` complete ones."""
    complete = complete_versions(spark, path)
    for number in _numbers(spark, path, "version-*"):
        if number < complete[-kept:][0]:
            drop_folder(spark, version_path(path, number))
