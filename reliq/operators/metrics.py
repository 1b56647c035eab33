"""Daily business metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reliq.functions.numbers import mean_money, rate
from reliq.schemas import MONEY


def daily_metrics(fact: DataFrame) -> DataFrame:
    """Counts, value and success rate per transaction date.

    Spark first aggregates per date and account, so a day that holds a third of all
    rows is spread over its accounts.
    """
    grouped = fact.groupBy(F.col("transaction_date").alias("metric_date")).agg(
        F.count("*").alias("total_transactions"),
        F.sum("amount").alias("_value"),
        F.count_if(F.col("status") == "success").alias("successful_count"),
        F.count_if(F.col("status") == "failed").alias("failed_count"),
        F.countDistinct("account_id").alias("active_accounts"),
    )
    rows = F.col("total_transactions")
    return grouped.select(
        "metric_date",
        "total_transactions",
        F.col("_value").cast(MONEY).alias("total_value"),
        "successful_count",
        "failed_count",
        rate(F.col("successful_count"), rows).alias("success_rate"),
        mean_money(F.col("_value"), rows).alias("avg_transaction"),
        "active_accounts",
    )
