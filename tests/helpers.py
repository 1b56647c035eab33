"""Small landed frames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from reliq.schemas import LAYERS, RAW

EARLY = dt.datetime(2024, 5, 1, 8, tzinfo=dt.timezone.utc)


def landed(spark: SparkSession, table: str, rows: list[tuple]) -> DataFrame:
    """Rows of text columns; a last value beyond them is the arrival in seconds."""
    names = RAW[table].names
    filled = []
    for row in rows:
        offset = row[len(names)] if len(row) > len(names) else 0
        filled.append((*row[: len(names)], EARLY + dt.timedelta(seconds=offset)))
    return spark.createDataFrame(filled, LAYERS["raw"][table])


def transaction(id="t1", account="a1", date="2024-05-01 10:00:00", amount="10.00", currency="EUR",
                status="success", merchant="shop", arrival=0) -> tuple:
    return (id, account, date, amount, currency, status, merchant, arrival)


def accounts_frame(spark: SparkSession, *ids: str) -> DataFrame:
    rows = [(i, f"c-{i}", "EE") for i in ids]
    return spark.createDataFrame(rows, "account_id string, customer_id string, customer_country string")


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
