"""Writes of layer tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from reliq.sinks.versions import write_version
from reliq.sources.layers import layer_path


def reload_table(df: DataFrame, root: str, layer: str, table: str, partition_by: str | None = None) -> str:
    """Replace a whole table and return the folder of its new version."""
    return write_version(df, layer_path(root, layer, table), partition_by)


def observed(df: DataFrame, metrics: dict[str, Column]) -> tuple[DataFrame, Callable[[], dict]]:
    """The frame with totals taken while it is written, and what returns them afterwards.

    The frame is to be written once. Totals of a frame without rows may be missing, and are None.
    """
    seen = Observation()
    watched = df.observe(seen, *[total.alias(name) for name, total in metrics.items()])
    return watched, lambda: {name: seen.get.get(name) for name in metrics}


def sized(df: DataFrame, *columns: str | Column) -> DataFrame:
    """The frame dealt by columns of few values, in partitions bounded by bytes.

    Written by the first of them, it makes files of about the advisory partition size, however many
    tasks or values there were; a value with most of the rows is split.
    """
    return df.hint("rebalance", *[F.col(column) if isinstance(column, str) else column for column in columns])


def save_mart(df: DataFrame, name: str) -> None:
    """Materialise a model as a catalog table."""
    df.write.mode("overwrite").saveAsTable(name)


def publish_view(df: DataFrame, name: str) -> None:
    """Materialise a model as a view of this session."""
    df.createOrReplaceTempView(name)
