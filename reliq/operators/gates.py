"""Quality gates: predicates over row counts, audited one row per check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reliq.functions.numbers import four_digits, guarded_rate

# The limits of the gates and the texts stored with them.
MAX_REJECT_RATE = 0.10
MIN_FACT_SHARE = 0.90
MIN_INSTITUTIONS = 100


class GateFailure(ValueError):
    """Some checks of a run failed."""


def _checks(counts: DataFrame, checks: Sequence[tuple[str, Column, Column, str]]) -> DataFrame:
    """One row per check from a one-row frame of counts."""
    entries = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.when(passed, F.lit("passed")).otherwise(F.lit("failed")).alias("check_status"),
            observed.cast("string").alias("observed_value"),
            F.lit(expected).alias("expected_value"),
        )
        for name, passed, observed, expected in checks
    ]
    return counts.select(F.inline(F.array(*entries)))


def transaction_gates(counts: DataFrame) -> DataFrame:
    """Gates over ``raw_rows``, ``fact_rows`` and ``quarantined_rows``."""
    raw, fact = F.col("raw_rows"), F.col("fact_rows")
    share = F.when(raw > 0, guarded_rate(F.col("quarantined_rows"), raw)).otherwise(F.lit(1.0))
    return _checks(
        counts,
        [
            ("fact_table_populated", fact > 0, fact, ">0"),
            ("reject_rate_below_10pct", share < MAX_REJECT_RATE, four_digits(share), "<0.10"),
            (
                "raw_to_fact_reasonable",
                fact.cast("double") >= raw.cast("double") * MIN_FACT_SHARE,
                F.concat_ws("/", fact.cast("string"), raw.cast("string")),
                "≥90%",
            ),
        ],
    )


def institution_gates(counts: DataFrame) -> DataFrame:
    """Gates over ``valid_rows`` and ``rejected_rows``."""
    valid, rejected = F.col("valid_rows"), F.col("rejected_rows")
    share = guarded_rate(rejected, valid + rejected)
    return _checks(
        counts,
        [
            ("at_least_100_institutions", valid >= MIN_INSTITUTIONS, valid, ">=100"),
            ("reject_rate_below_10pct", share < MAX_REJECT_RATE, four_digits(share), "<0.10"),
        ],
    )


def audit_rows(checks: DataFrame, run_id: str, checked_at: Column, message: str = "") -> DataFrame:
    return checks.select(
        F.lit(run_id).alias("dag_run_id"),
        "check_name",
        "check_status",
        "observed_value",
        "expected_value",
        F.lit(message).alias("message"),
        checked_at.alias("checked_at"),
    )


def require_passed(checks: DataFrame) -> None:
    """Raise with the names of all failed checks."""
    failed = [row[0] for row in checks.filter("check_status = 'failed'").select("check_name").collect()]
    if failed:
        raise GateFailure(f"Gates not passed: {failed}")
