"""Constraint tests.

A test is a frame of offending entries; its result row holds the number of entries
and whether they should warn or fail the build.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reliq.operators.skew import NONE, Hot, salted_join

# The statuses a transaction may have.
STATUSES = ["success", "failed", "pending"]


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; null is ignored."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("unique_field"))
    return counted.agg(F.count("*").alias("n_records")).filter("n_records > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull()).select(column)


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Distinct values outside the domain, with their rows; null passes."""
    outside = df.filter(~F.col(column).isin(list(values)))
    return outside.groupBy(F.col(column).alias("value_field")).agg(F.count("*").alias("n_records"))


def relationships(
    child: DataFrame, parent: DataFrame, column: str, field: str | None = None, hot: Hot = NONE
) -> DataFrame:
    """Child values without a parent, one entry per child row; null is ignored."""
    keys = parent.select(F.col(field or column).alias("from_field"))
    values = child.filter(F.col(column).isNotNull()).select(F.col(column).alias("from_field"))
    return salted_join(values, keys, "from_field", "left_anti", hot)


# Fixed values below and above: the columns of test results.
def verdict(name: str | Column, failures: Column) -> list[Column]:
    """The result columns of a test."""
    label = F.lit(name) if isinstance(name, str) else name
    bad = failures != 0
    return [
        label.alias("test_name"),
        failures.cast("bigint").alias("failures"),
        bad.alias("should_warn"),
        bad.alias("should_error"),
    ]


def result(name: str, offending: DataFrame) -> DataFrame:
    return offending.agg(F.count("*").alias("_n")).select(*verdict(name, F.col("_n")))


def orphan_result(name: str, child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Result of ``relationships``, counting child rows per key before the join."""
    per_key = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_rows"))
    orphans = per_key.join(parent.select(column), column, "left_anti")
    counted = orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("_n"))
    return counted.select(*verdict(name, F.col("_n")))


def scan_results(
    df: DataFrame,
    table: str,
    required: Sequence[str] = (),
    domains: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Results of all ``not_null`` and ``accepted_values`` tests of a table, in one pass."""
    counts = {f"not_null_{table}_{name}": F.count_if(F.col(name).isNull()) for name in required}
    for name, values in (domains or {}).items():
        outside = F.when(~F.col(name).isin(list(values)), F.col(name))
        counts[f"accepted_values_{table}_{name}"] = F.countDistinct(outside)
    return _result_rows(df.agg(*[count.alias(name) for name, count in counts.items()]))


def key_results(df: DataFrame, table: str, key: str) -> DataFrame:
    """Results of the ``unique`` and ``not_null`` tests of a key, from one grouping."""
    column = F.col(key)
    totals = df.groupBy(key).agg(F.count("*").alias("_n")).agg(
        F.count_if(column.isNotNull() & (F.col("_n") > 1)).alias(f"unique_{table}_{key}"),
        F.coalesce(F.sum(F.when(column.isNull(), F.col("_n"))), F.lit(0)).alias(f"not_null_{table}_{key}"),
    )
    return _result_rows(totals)


def _result_rows(totals: DataFrame) -> DataFrame:
    """One result row per column of a one-row frame of failures."""
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("n")) for n in totals.columns]))
    return totals.select(rows.alias("t")).select(*verdict(F.col("t.name"), F.col("t.n")))


def _keyed(df: DataFrame, side: str, amount: Column | None = None, **keys: str) -> DataFrame:
    """A row per key of each row: its ``kind`` and ``key``, the side it is on, and whether the amount is missing."""
    entries = [F.struct(F.lit(kind).alias("kind"), F.col(name).cast("string").alias("key")) for kind, name in keys.items()]
    missing = F.lit(False) if amount is None else amount.isNull()
    return df.select(F.inline(F.array(*entries)), F.lit(side).alias("side"), missing.alias("no_amount"))


def mart_results(customers: DataFrame, accounts: DataFrame, fact: DataFrame) -> DataFrame:
    """The nine tests of the star schema, from one pass over each table and one exchange.

    Facts and dimensions meet in one aggregate that groups by each key on its own, so a value
    that occurs twice, is missing, lies outside its domain or has no parent is one group. Rows
    are counted per task before they are shuffled: a hot key is one row for each.
    """
    keyed = [
        _keyed(fact, "fact", F.col("amount"), transaction="transaction_id", account="account_id", status="status"),
        _keyed(accounts, "dimension", account="account_id"),
        _keyed(customers, "dimension", customer="customer_id"),
    ]
    groups = reduce(DataFrame.unionByName, keyed).groupBy("kind", "key").agg(
        F.count_if(F.col("side") == "fact").alias("facts"),
        F.count_if(F.col("side") == "dimension").alias("parents"),
        F.count_if("no_amount").alias("no_amount"),
    )
    known, is_null = F.col("key").isNotNull(), F.col("key").isNull()

    def rows(kind: str, side: str, test: Column) -> Column:
        return F.coalesce(F.sum(F.when((F.col("kind") == kind) & test, F.col(side))), F.lit(0))

    def keys(kind: str, test: Column) -> Column:
        return F.count_if((F.col("kind") == kind) & known & test)

    totals = groups.agg(
        keys("customer", F.col("parents") > 1).alias("unique_dim_customer_customer_id"),
        rows("customer", "parents", is_null).alias("not_null_dim_customer_customer_id"),
        keys("account", F.col("parents") > 1).alias("unique_dim_account_account_id"),
        rows("account", "parents", is_null).alias("not_null_dim_account_account_id"),
        keys("transaction", F.col("facts") > 1).alias("unique_fact_transactions_transaction_id"),
        rows("transaction", "facts", is_null).alias("not_null_fact_transactions_transaction_id"),
        rows("status", "no_amount", F.lit(True)).alias("not_null_fact_transactions_amount"),
        keys("status", ~F.col("key").isin(STATUSES)).alias("accepted_values_fact_transactions_status"),
        rows("account", "facts", known & (F.col("parents") == 0)).alias("relationships_fact_transactions_account_id"),
    )
    return _result_rows(totals)
