"""Reporting queries over the modelled tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reliq.functions.casts import exact_amount
from reliq.operators.quarantine import LOADED
from reliq.operators.topk import cutoff_day, first_rows, newest_days
from reliq.schemas import FACT_MONTH, MONEY

# The size of the published report and its columns.
FACT_SNAPSHOT_ROWS = 20_000
SNAPSHOT_COLUMNS = [
    "transaction_id",
    "account_id",
    "customer_id",
    "customer_country",
    "account_type",
    "transaction_date",
    "amount",
    "currency",
    "status",
    "merchant",
]


def side_by_side(*totals: DataFrame) -> DataFrame:
    """One row with the columns of several one-row frames, without a join."""
    stacked = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), totals)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


def reject_breakdown(quarantine: DataFrame) -> DataFrame:
    """Quarantined rows per reason, most frequent first."""
    return quarantine.groupBy("reject_reason").count().orderBy(F.desc("count"), "reject_reason")


def status_counts(fact: DataFrame) -> DataFrame:
    """Transactions per status, most frequent first; a missing status is left out."""
    known = fact.filter("status is not null")
    return known.groupBy("status").count().orderBy(F.desc("count"), "status")


def fact_kpis(fact: DataFrame, breakdown: DataFrame) -> DataFrame:
    """Transactions, value in mixed currencies, countries, merchants and quarantined rows.

    The distinct counts run on the few pairs of country and merchant.
    """
    pairs = fact.groupBy("customer_country", "merchant").agg(
        F.count("*").alias("_rows"), F.sum("amount").alias("_value")
    )
    totals = pairs.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("transactions"),
        F.coalesce(F.sum("_value"), F.lit(0)).cast(MONEY).alias("total_value"),
        F.countDistinct("customer_country").alias("countries"),
        F.countDistinct("merchant").alias("merchants"),
    )
    rejected = breakdown.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("quarantined"))
    return side_by_side(totals, rejected)


def classified_totals(classified: DataFrame) -> DataFrame:
    """One row with ``fact_kpis``, from rows classified once with their account context.

    A loaded row whose amount rounds to nothing is neither a fact nor a reject.
    """
    amount = exact_amount(F.col("amount"), strict=True).cast(MONEY)
    kind = F.when(F.col("outcome") != LOADED, "reject").when(amount > 0, "fact")
    own = {name: F.when(F.col("kind") == "fact", F.col(name)) for name in ("customer_country", "merchant", "value")}
    marked = classified.withColumns({"kind": kind, "value": amount}).filter("kind is not null")
    pairs = marked.groupBy("kind", own["customer_country"].alias("country"), own["merchant"].alias("shop")).agg(
        F.count("*").alias("_rows"), F.sum(own["value"]).alias("_value")
    )

    def rows_of(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("_rows"))), F.lit(0))

    return pairs.agg(
        rows_of("fact").alias("transactions"),
        F.coalesce(F.sum("_value"), F.lit(0)).cast(MONEY).alias("total_value"),
        F.countDistinct("country").alias("countries"),
        F.countDistinct("shop").alias("merchants"),
        rows_of("reject").alias("quarantined"),
    )


def country_rollup(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Transactions and value per customer country; unknown customers share a null group.

    The fact is first summed per customer, so the join moves one row per customer.
    """
    per_customer = fact.groupBy("customer_id").agg(
        F.count("*").alias("_rows"), F.sum("amount").alias("_value")
    )
    placed = per_customer.join(customers.select("customer_id", "country"), "customer_id", "left")
    return (
        placed.groupBy("country")
        .agg(
            F.sum("_rows").alias("txns"),
            F.round(F.sum("_value"), 2).cast(MONEY).alias("total_value"),
        )
        .orderBy(F.desc("total_value"), "country")
    )


def layer_row_counts(
    raw: DataFrame, staging: DataFrame, fact: DataFrame, breakdown: DataFrame
) -> DataFrame:
    """One row with the size of every layer."""
    return side_by_side(
        raw.agg(F.count("*").alias("raw_rows")),
        staging.agg(F.count("*").alias("staging_rows")),
        fact.agg(F.count("*").alias("fact_rows")),
        breakdown.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("quarantined_rows")),
    )


def latest_facts(fact: DataFrame, n: int = FACT_SNAPSHOT_ROWS) -> DataFrame:
    """The newest facts in the published columns; equal dates go by transaction id."""
    recent = newest_days(fact.select(*SNAPSHOT_COLUMNS), "transaction_date", n)
    return first_rows(recent, [F.desc("transaction_date"), F.asc("transaction_id")], n)


def latest_dated_facts(fact: DataFrame, days: DataFrame, n: int = FACT_SNAPSHOT_ROWS) -> DataFrame:
    """``latest_facts`` of a table stored by month, whose rows per day are known.

    ``days`` are the daily metrics of these facts. The cutoff day is found there, so the facts are
    read once, from the months that hold it or later days.
    """
    cutoff = cutoff_day(days, n)
    if cutoff is not None:
        day = F.lit(cutoff)
        fact = fact.filter((F.col(FACT_MONTH) >= F.trunc(day, "month")) & (F.col("transaction_date") >= day))
    return first_rows(fact.select(*SNAPSHOT_COLUMNS), [F.desc("transaction_date"), F.asc("transaction_id")], n)


def latest_metrics(metrics: DataFrame, n: int | None = None) -> DataFrame:
    """Daily metrics, newest first."""
    newest = [F.desc("metric_date")]
    return metrics.orderBy(*newest) if n is None else first_rows(metrics, newest, n)


def value_trend(metrics: DataFrame) -> DataFrame:
    """Daily value in calendar order."""
    return metrics.select(F.to_date("metric_date").alias("metric_date"), "total_value").orderBy("metric_date")
