"""Typed, validated and deduplicated rows, and the views over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reliq.functions.casts import as_date, as_timestamp, exact_amount, money, required
from reliq.operators.dedupe import first_per_key
from reliq.operators.skew import NONE, Hot, salted_join

# The columns of a transaction, in order.
TRANSACTION_COLUMNS = [
    "transaction_id",
    "account_id",
    "transaction_date",
    "amount",
    "currency",
    "status",
    "merchant",
]


def copy_order(*columns: str) -> list[Column]:
    """The order among rows of one key: arrival, then every business column."""
    return [F.col("ingested_at"), *[F.col(name) for name in columns]]


def transaction_order() -> list[Column]:
    return copy_order(
        "account_id", "transaction_date", "_amount", "currency", "status", "merchant", "amount"
    )


def valid_customers(raw: DataFrame) -> DataFrame:
    return raw.filter("customer_id is not null and customer_id <> '' and full_name is not null")


def stage_customers(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Customers with an id and a name, one row per id."""
    order = copy_order("full_name", "email", "country", "signup_date")
    kept = first_per_key(valid_customers(raw), "customer_id", order)
    return kept.select(
        "customer_id",
        "full_name",
        "email",
        "country",
        as_date(F.col("signup_date"), strict).alias("signup_date"),
    )


def with_parent(
    rows: DataFrame, parents: DataFrame, key: str, hot: Hot = NONE, carry: Sequence[str] = ()
) -> DataFrame:
    """Rows whose parent exists, with the columns to ``carry`` from it; parents are unique."""
    how = "inner" if carry else "left_semi"
    return salted_join(rows, parents.select(key, *carry), key, how, hot)


def stage_accounts(
    raw: DataFrame,
    customers: DataFrame,
    strict: bool = True,
    hot: Hot = NONE,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Accounts with an id and a staged customer, one row per id.

    ``hot`` lists customers. Customer columns to ``carry`` spare a later join.
    """
    named = raw.filter("account_id is not null")
    owned = with_parent(named, customers, "customer_id", hot, carry)
    order = copy_order("customer_id", "account_type", "currency", "opened_date")
    return first_per_key(owned, "account_id", order).select(
        "account_id",
        "customer_id",
        "account_type",
        "currency",
        as_date(F.col("opened_date"), strict).alias("opened_date"),
        *carry,
    )


def with_exact_amount(raw: DataFrame, strict: bool = True) -> DataFrame:
    return raw.withColumn("_amount", exact_amount(F.col("amount"), strict))


def has_readable_date() -> Column:
    """The date is missing or can be read."""
    text = F.col("transaction_date")
    return text.isNull() | as_timestamp(text, strict=False).isNotNull()


def typed_transactions(rows: DataFrame, strict: bool = True, carry: Sequence[str] = ()) -> DataFrame:
    """Cents and timestamps; a strict load refuses a row without date, currency or status."""
    columns = {
        "transaction_id": F.col("transaction_id"),
        "account_id": F.col("account_id"),
        "transaction_date": as_timestamp(F.col("transaction_date"), strict),
        "amount": money(exact_amount(F.col("amount"), strict)),
        "currency": F.col("currency"),
        "status": F.col("status"),
        "merchant": F.col("merchant"),
    }
    if strict:
        for name in ("transaction_date", "currency", "status"):
            columns[name] = required(columns[name], name)
    return rows.select(*[column.alias(name) for name, column in columns.items()], *carry)


def stage_transactions(
    raw: DataFrame,
    accounts: DataFrame,
    strict: bool = True,
    hot: Hot = NONE,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Transactions with an id, a positive amount and a staged account, one row per id.

    ``hot`` lists accounts. Account columns to ``carry`` spare a later join. A lenient
    load also leaves out malformed dates.
    """
    positive = with_exact_amount(raw, strict).filter("transaction_id is not null and _amount > 0")
    if not strict:
        positive = positive.filter(has_readable_date())
    valid = with_parent(positive, accounts, "account_id", hot, carry)
    return typed_transactions(first_per_key(valid, "transaction_id", transaction_order()), strict, carry)


def stg_customers(staged: DataFrame) -> DataFrame:
    return staged.filter("customer_id is not null").select(
        "customer_id", "full_name", "email", "country", F.col("signup_date").cast("date").alias("signup_date")
    )


def stg_accounts(staged: DataFrame) -> DataFrame:
    return staged.filter("account_id is not null").select(
        "account_id",
        "customer_id",
        "account_type",
        "currency",
        F.col("opened_date").cast("date").alias("opened_date"),
    )


def stg_transactions(staged: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Staged transactions that are still positive in cents."""
    return staged.filter("transaction_id is not null and amount > 0").select(
        "transaction_id",
        "account_id",
        "transaction_date",
        money(F.col("amount")).alias("amount"),
        "currency",
        "status",
        "merchant",
        *carry,
    )
