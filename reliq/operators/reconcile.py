"""Source totals against target totals."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reliq.functions.casts import exact_amount
from reliq.functions.literals import literal_rows
from reliq.operators.gates import GateFailure

# Variance in percent below which a metric is ok, or a warning.
OK_BELOW = 5
WARNING_BELOW = 10

VALUE = "decimal(20,4)"
PAIRS = T.StructType(
    [T.StructField("metric_name", T.StringType())]
    + [T.StructField(name, T.DecimalType(20, 4)) for name in ("source_value", "target_value")]
)


def _metric_rows(totals: DataFrame, value_name: str) -> DataFrame:
    names = ["transaction_count", "transaction_value", "successful_count"]
    entries = [
        F.struct(F.lit(name).alias("metric_name"), F.col(name).cast(VALUE).alias(value_name))
        for name in names
    ]
    return totals.select(F.inline(F.array(*entries)))


def source_metrics(strict: bool = True) -> dict[str, Column]:
    """Rows, positive value and successes of landed transactions."""
    amount = exact_amount(F.col("amount"), strict)
    return {
        "transaction_count": F.count("*"),
        "transaction_value": F.coalesce(F.sum(F.when(amount > 0, amount.cast("decimal(28,8)"))), F.lit(0)),
        "successful_count": F.count_if(F.col("status") == "success"),
    }


def target_metrics() -> dict[str, Column]:
    """Rows, value and successes of facts."""
    return {
        "transaction_count": F.count("*"),
        "transaction_value": F.coalesce(F.sum("amount"), F.lit(0)),
        "successful_count": F.count_if(F.col("status") == "success"),
    }


def _totals(df: DataFrame, metrics: dict[str, Column], value_name: str) -> DataFrame:
    return _metric_rows(df.agg(*[total.alias(name) for name, total in metrics.items()]), value_name)


def source_totals(raw: DataFrame, strict: bool = True) -> DataFrame:
    """The source metrics of the landed transactions, in one pass."""
    return _totals(raw, source_metrics(strict), "source_value")


def target_totals(fact: DataFrame) -> DataFrame:
    return _totals(fact, target_metrics(), "target_value")


def reconcile_values(spark: SparkSession, source: dict, target: dict) -> DataFrame:
    """The metrics of totals that were taken while both tables were written."""
    pairs = [(name, Decimal(source[name] or 0), Decimal(target[name] or 0)) for name in source]
    return with_variance(literal_rows(spark, pairs, PAIRS))


def with_variance(pairs: DataFrame) -> DataFrame:
    """Difference, variance in percent and status of source and target values.

    A source of zero counts as no variance, whatever the target holds. The status
    compares products, so it does not depend on a rounded quotient.
    """
    source, target = F.col("source_value"), F.col("target_value")
    gap = source - target
    variance = F.when(source == 0, F.lit(0)).otherwise(gap * 100 / F.nullif(source, F.lit(0)))
    distance, size = F.abs(gap) * 100, F.abs(source)
    status = (
        F.when((source == 0) | (distance < size * OK_BELOW), "ok")
        .when(distance < size * WARNING_BELOW, "warning")
        .otherwise("failed")
    )
    return pairs.withColumns(
        {
            "difference": gap.cast(VALUE),
            "variance_pct": variance.cast("decimal(10,6)"),
            "status": status,
        }
    )


def reconcile_totals(raw: DataFrame, fact: DataFrame, strict: bool = True) -> DataFrame:
    """The three metrics of landed against modelled transactions."""
    return with_variance(source_totals(raw, strict).join(target_totals(fact), "metric_name"))


def audit_rows(metrics: DataFrame, run_id: str, checked_at: Column) -> DataFrame:
    return metrics.select(
        F.lit(run_id).alias("dag_run_id"),
        "metric_name",
        "source_value",
        "target_value",
        "difference",
        "variance_pct",
        "status",
        checked_at.alias("checked_at"),
    )


def require_reconciled(metrics: DataFrame) -> None:
    failed = [row[0] for row in metrics.filter("status = 'failed'").select("metric_name").collect()]
    if failed:
        raise GateFailure(f"Totals of source and target are too far apart: {failed}")
