"""Institution records: validation, summary and rollups."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reliq.functions.casts import coerced_number
from reliq.functions.numbers import millionth
from reliq.operators.quantiles import exact_median
from reliq.operators.reports import side_by_side
from reliq.operators.topk import first_rows
from reliq.sources.files import utc

# The reasons of a rejected institution, and the reported columns.
MISSING = "missing_cert_or_name"
NON_POSITIVE = "non_positive_assets"
DISPLAY_COLUMNS = ["CERT", "NAME", "CITY", "STALP", "ASSET", "DEP", "NETINC", "ROA", "ROE", "ACTIVE"]


def with_reason(records: DataFrame) -> DataFrame:
    """Add ``_reason``: the first rule a record breaks, or null."""
    no_cert = F.coalesce(F.col("CERT") == 0, F.lit(True))
    no_name = F.coalesce(F.col("NAME") == "", F.lit(True))
    return records.withColumn(
        "_reason",
        F.when(no_cert | no_name, F.lit(MISSING)).when(
            F.coalesce(F.col("ASSET"), F.lit(0)) <= 0, F.lit(NON_POSITIVE)
        ),
    )


def valid_records(judged: DataFrame) -> DataFrame:
    return judged.filter("_reason is null").drop("_reason")


def rejected_records(judged: DataFrame) -> DataFrame:
    return judged.filter("_reason is not null")


def outcome_counts(judged: DataFrame) -> DataFrame:
    """One row with ``valid_rows`` and ``rejected_rows``."""
    return judged.agg(
        F.count_if(F.col("_reason").isNull()).alias("valid_rows"),
        F.count_if(F.col("_reason").isNotNull()).alias("rejected_rows"),
    )


def reason_counts(judged: DataFrame) -> DataFrame:
    return judged.filter("_reason is not null").groupBy("_reason").count()


def _assets() -> Column:
    return coerced_number(F.col("ASSET")).cast("decimal(18,2)")


def summarise(records: DataFrame, fetched_at: datetime | None = None) -> DataFrame:
    """Records, states, and total assets in billions; halves round to even. ``fetched_at`` is ISO text."""
    state = F.when(F.col("STALP") != "", F.col("STALP"))
    total = F.coalesce(F.sum(_assets()), F.lit(0))
    return records.agg(
        F.count("*").alias("count"),
        F.countDistinct(state).alias("states"),
        F.bround(millionth(total), 2).cast("decimal(18,2)").alias("total_assets_usd_billions"),
    ).withColumn("fetched_at", F.lit(utc(fetched_at).isoformat()))


def kpis(records: DataFrame) -> DataFrame:
    """Institutions, states, and total and median assets.

    Assets are in thousands, so a millionth of them is in billions.
    """
    median = exact_median(records.select(coerced_number(F.col("ASSET")).alias("asset")), "asset")
    totals = records.agg(
        F.count("*").alias("institutions"),
        F.countDistinct("STALP").alias("states"),
        millionth(F.coalesce(F.sum(_assets()), F.lit(0))).alias("total_assets_b"),
    )
    in_billions = (F.col("median").cast("decimal(18,3)") * F.expr("0.000001BD")).cast("decimal(28,9)")
    return side_by_side(totals, median.select(in_billions.alias("median_assets_b")))


def top_by_assets(records: DataFrame, n: int = 20) -> DataFrame:
    """The largest institutions in billions; unknown assets are left out, ties go by id."""
    ranked = records.withColumn("ASSET", _assets()).filter("ASSET is not null")
    top = first_rows(ranked.select("CERT", "NAME", "STALP", "ASSET"), [F.desc("ASSET"), F.asc("CERT")], n)
    return top.select("CERT", "NAME", "STALP", millionth(F.col("ASSET")).alias("ASSET"))


def by_state(records: DataFrame) -> DataFrame:
    """Banks and assets per state; records without a state are left out."""
    grouped = records.filter("STALP is not null").groupBy("STALP")
    return grouped.agg(
        F.count("CERT").alias("banks"),
        F.coalesce(F.sum(_assets()), F.lit(0)).cast("decimal(28,2)").alias("assets"),
    ).withColumn("assets_b", millionth(F.col("assets")))


def display(records: DataFrame) -> DataFrame:
    """The reported columns that exist, in their fixed order."""
    return records.select(*[name for name in DISPLAY_COLUMNS if name in records.columns])
