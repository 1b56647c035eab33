"""Rejected transactions with their reasons.

A row is stored once per reason that holds for it. Duplicates are ranked among all
landed rows, loaded rows among the valid ones, so a row can be loaded and quarantined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reliq.operators.dedupe import mark_firsts
from reliq.operators.skew import NONE, Hot, HotKeys, salted_join
from reliq.operators.staging import (
    TRANSACTION_COLUMNS,
    has_readable_date,
    transaction_order,
    typed_transactions,
    with_exact_amount,
)

# The reasons stored with a reject, and the tag of an accepted row.
NEGATIVE = "negative_amount"
ORPHAN = "orphan_account"
DUPLICATE = "duplicate_transaction_id"
REASONS = [NEGATIVE, ORPHAN, DUPLICATE]
LOADED = "loaded"

# Reasons beyond the default ones, for lenient loads and for incomplete rows.
MALFORMED = ["malformed_amount", "malformed_date"]
MISSING = ["missing_transaction_id", "missing_amount"]


def with_lane(rows: DataFrame, hot: Hot) -> DataFrame:
    """Note the input split of each row where hot keys are spread by it."""
    return rows.withColumn("_lane", F.spark_partition_id()) if hot else rows


def classify_transactions(
    raw: DataFrame,
    accounts: DataFrame,
    strict: bool = True,
    tag_missing: bool = False,
    hot: HotKeys | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Every landed row once per ``outcome``: loaded, or a reject reason.

    One scan, one join and one exchange on the transaction id serve the staging
    table and the quarantine. What can be told from a row is told behind the exchange, which
    then moves little more than the landed texts. ``accounts`` holds one row per account id; account columns
    to ``carry`` spare a later join.
    """
    hot = hot or {}
    hot_ids = hot.get("transaction_id", NONE)
    known = accounts.select("account_id", *carry, F.lit(True).alias("_known"))
    joined = salted_join(with_lane(raw, hot_ids), known, "account_id", "left", hot.get("account_id", NONE))
    if not hot_ids:
        joined = joined.repartition("transaction_id")
    checked = with_exact_amount(joined, strict).withColumns(
        {"_orphan": F.col("_known").isNull(), "_negative": F.coalesce(F.expr("_amount <= 0"), F.lit(False))}
    )
    positive = F.coalesce(F.col("_amount") > 0, F.lit(False))
    date_ok = F.lit(True) if strict else has_readable_date()
    checked = checked.withColumn(
        "_valid", F.col("transaction_id").isNotNull() & positive & ~F.col("_orphan") & date_ok
    )
    marked = mark_firsts(checked, "transaction_id", transaction_order(), "_valid", hot_ids)

    outcomes = {
        LOADED: F.col("is_first_valid"),
        NEGATIVE: F.col("_negative"),
        ORPHAN: F.col("_orphan"),
        DUPLICATE: ~F.col("is_first"),
    }
    if not strict:
        outcomes[MALFORMED[0]] = F.col("amount").isNotNull() & F.col("_amount").isNull()
        outcomes[MALFORMED[1]] = ~date_ok
    if tag_missing:
        outcomes[MISSING[0]] = F.col("transaction_id").isNull()
        outcomes[MISSING[1]] = F.col("amount").isNull()
    matched = F.array_compact(F.array(*[F.when(test, F.lit(tag)) for tag, test in outcomes.items()]))
    return marked.select(*TRANSACTION_COLUMNS, *carry, F.explode(matched).alias("outcome"))


def loaded_rows(classified: DataFrame, strict: bool = True, carry: Sequence[str] = ()) -> DataFrame:
    """The staging rows of a classified frame."""
    return typed_transactions(classified.filter(F.col("outcome") == LOADED), strict, carry)


def rejected_rows(classified: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The quarantine rows of a classified frame, as they were landed."""
    rejected = classified.filter(F.col("outcome") != LOADED)
    return rejected.select(*TRANSACTION_COLUMNS, F.col("outcome").alias("reject_reason"), *carry)


def quarantine_transactions(
    raw: DataFrame,
    accounts: DataFrame,
    strict: bool = True,
    tag_missing: bool = False,
    hot: HotKeys | None = None,
) -> DataFrame:
    return rejected_rows(classify_transactions(raw, accounts, strict, tag_missing, hot))


def negative_amounts(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Rows at or below zero; needs no shuffle."""
    return with_exact_amount(raw, strict).filter("_amount <= 0").select(
        *TRANSACTION_COLUMNS, F.lit(NEGATIVE).alias("reject_reason")
    )


def orphan_transactions(raw: DataFrame, accounts: DataFrame, hot: Hot = NONE) -> DataFrame:
    """Rows whose account was not staged, also those without one; ``hot`` lists accounts."""
    orphans = salted_join(raw, accounts.select("account_id"), "account_id", "left_anti", hot)
    return orphans.select(*TRANSACTION_COLUMNS, F.lit(ORPHAN).alias("reject_reason"))


def duplicate_transactions(raw: DataFrame, strict: bool = True, hot: Hot = NONE) -> DataFrame:
    """Every row of a transaction id but the first; ``hot`` lists transaction ids."""
    parsed = with_lane(with_exact_amount(raw, strict), hot).withColumn("_valid", F.lit(True))
    marked = mark_firsts(parsed, "transaction_id", transaction_order(), "_valid", hot)
    return marked.filter(~F.col("is_first")).select(
        *TRANSACTION_COLUMNS, F.lit(DUPLICATE).alias("reject_reason")
    )


def count_by_reason(raw: DataFrame, accounts: DataFrame, strict: bool = True) -> DataFrame:
    """Rows per reason without ranking them: only keys and counts are shuffled."""
    negative = with_exact_amount(raw, strict).filter("_amount <= 0").agg(F.count("*").alias("count"))
    orphan = (
        raw.groupBy("account_id")
        .count()
        .join(accounts.select("account_id"), "account_id", "left_anti")
        .agg(F.coalesce(F.sum("count"), F.lit(0)).alias("count"))
    )
    duplicate = (
        raw.groupBy("transaction_id").count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("count"))
    )
    counts = [
        part.select(F.lit(reason).alias("reject_reason"), "count")
        for reason, part in zip(REASONS, (negative, orphan, duplicate))
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).filter("count > 0")
