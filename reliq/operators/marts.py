"""The star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reliq.functions.dates import padded_day_name, padded_month_name, weekday_from_sunday
from reliq.operators.skew import NONE, Hot, salted_join
from reliq.operators.staging import stage_accounts, stage_transactions, stg_transactions
from reliq.schemas import FACT_MONTH

# The calendar the date dimension covers by default.
FIRST_DAY = "2024-01-01"
LAST_DAY = "2027-12-31"

# The columns of the star schema, in order.
CUSTOMER_CONTEXT = ["customer_name", "customer_country"]
ACCOUNT_CONTEXT = ["customer_id", "customer_country", "account_type"]
ACCOUNT_COLUMNS = [
    "account_id",
    "customer_id",
    "customer_name",
    "customer_country",
    "account_type",
    "currency",
    "opened_date",
]
FACT_COLUMNS = [
    "transaction_id",
    "account_id",
    "customer_id",
    "customer_country",
    "account_type",
    "transaction_date",
    "transaction_day",
    "transaction_hour",
    "amount",
    "currency",
    "status",
    "merchant",
]


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        "full_name",
        "email",
        "country",
        "signup_date",
        F.year("signup_date").alias("signup_year"),
    )


def customer_context(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        F.col("full_name").alias("customer_name"),
        F.col("country").alias("customer_country"),
    )


def dim_account(accounts: DataFrame, customers: DataFrame, hot: Hot = NONE) -> DataFrame:
    """Accounts with the name and country of their customer; ``hot`` lists customers."""
    return salted_join(accounts, customer_context(customers), "customer_id", "left", hot).select(
        *ACCOUNT_COLUMNS
    )


def dim_account_of_landed(
    raw: DataFrame, customers: DataFrame, strict: bool = True, hot: Hot = NONE
) -> DataFrame:
    """``dim_account`` straight from landed accounts.

    One join with the customers both checks the owner and brings its name and country.
    """
    staged = stage_accounts(raw, customer_context(customers), strict, hot, CUSTOMER_CONTEXT)
    return staged.select(*ACCOUNT_COLUMNS)


def spread_days(bounds: DataFrame) -> DataFrame:
    """One row per day from ``first_day`` to ``last_day`` of a one-row frame."""
    return bounds.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("date_day")
    )


def calendar(days: DataFrame) -> DataFrame:
    """The parts of each ``date_day``."""
    day = F.col("date_day")
    return days.select(
        "date_day",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        weekday_from_sunday(day).alias("day_of_week"),
        padded_day_name(day).alias("day_name"),
        padded_month_name(day).alias("month_name"),
        F.quarter(day).alias("quarter"),
    )


def dim_date(spark: SparkSession, first_day: str = FIRST_DAY, last_day: str = LAST_DAY) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(first_day).cast("date").alias("first_day"), F.lit(last_day).cast("date").alias("last_day")
    )
    return calendar(spread_days(bounds))


def dim_date_covering(facts: DataFrame) -> DataFrame:
    """The default calendar, stretched to every day the facts hold."""
    bounds = facts.agg(
        F.least(F.min("transaction_date"), F.lit(FIRST_DAY).cast("date")).alias("first_day"),
        F.greatest(F.max("transaction_date"), F.lit(LAST_DAY).cast("date")).alias("last_day"),
    )
    return calendar(spread_days(bounds))


def fact_transactions(transactions: DataFrame, accounts: DataFrame, hot: Hot = NONE) -> DataFrame:
    """One row per staged transaction, with its account and customer context.

    ``hot`` lists accounts.
    """
    context = accounts.select("account_id", *ACCOUNT_CONTEXT)
    return dated_facts(salted_join(transactions, context, "account_id", "left", hot))


def fact_of_landed(raw: DataFrame, accounts: DataFrame, strict: bool = True, hot: Hot = NONE) -> DataFrame:
    """``fact_transactions`` straight from landed transactions and ``dim_account``.

    One join with the accounts both checks the account and brings its context, so the
    transactions are shuffled once less than by way of staging.
    """
    staged = stage_transactions(raw, accounts, strict, hot, ACCOUNT_CONTEXT)
    return dated_facts(stg_transactions(staged, ACCOUNT_CONTEXT))


def dated_facts(transactions: DataFrame) -> DataFrame:
    """Facts from transactions that carry their account context."""
    moment = F.col("transaction_date")
    dated = transactions.withColumns(
        {
            "transaction_hour": F.hour(moment),
            "transaction_day": F.date_trunc("day", moment).cast("date"),
            "transaction_date": F.to_date(moment),
        }
    )
    return dated.select(*FACT_COLUMNS)


def with_month(facts: DataFrame) -> DataFrame:
    """Facts with the month that they are stored by; facts without a date share one."""
    return facts.withColumn(FACT_MONTH, F.trunc("transaction_date", "month"))
