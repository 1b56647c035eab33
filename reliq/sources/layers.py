"""Tables of the layers below one root folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reliq.schemas import LAYERS
from reliq.sinks.versions import current_path


def layer_path(root: str, layer: str, table: str) -> str:
    return f"{root}/{layer}/{table}"


def read_layer(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    """The current version of a stored table in its declared layout."""
    layout = LAYERS[layer][table]
    return stored_version(spark, root, layer, table).select(*layout.names)


def stored_version(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    """The current version of a stored table, with the columns that it is stored by."""
    path = layer_path(root, layer, table)
    return spark.read.schema(LAYERS[layer][table]).parquet(current_path(spark, path) or path)


def stored_columns(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    """A stored table with the columns that its files hold, declared or not."""
    path = layer_path(root, layer, table)
    return spark.read.option("mergeSchema", "true").parquet(current_path(spark, path) or path)


def table_columns(df: DataFrame) -> list[str]:
    """Column names in order."""
    return [field.name for field in df.schema.fields]
