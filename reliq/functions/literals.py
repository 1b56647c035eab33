"""Small frames of known rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A few rows as constants of the plan: they need no data of their own, and one task.

    ``createDataFrame`` deals its rows over all cores, which takes five times as long for one row.
    """
    structs = [
        F.struct(*[F.lit(value).cast(field.dataType).alias(field.name) for value, field in zip(row, schema.fields)])
        for row in rows
    ]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))
