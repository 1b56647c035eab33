"""Published snapshots. Every file written as one part is bounded by its report."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reliq.operators.reports import SNAPSHOT_COLUMNS, latest_metrics, reject_breakdown
from reliq.operators.runlog import recent_runs
from reliq.functions.together import together
from reliq.schemas import INSTITUTION, INSTITUTION_META
from reliq.sinks.tables import observed

# The published columns of a run.
RUN_COLUMNS = [
    "dag_run_id",
    "dag_id",
    "started_at",
    "finished_at",
    "status",
    "records_extracted",
    "records_loaded",
    "records_quarantined",
    "duration_seconds",
]


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    df.write.mode("overwrite").csv(
        path,
        header=True,
        escape='"',
        emptyValue="",
        timestampFormat="yyyy-MM-dd HH:mm:ss.SSSSSSxxx",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        compression=compression or "none",
    )


#: Reports that grow with the tables are packed.
PACKED = {"fact_transactions.csv": "gzip"}


def _publish(reports: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """Write reports side by side and return the rows of each."""
    watched = {name: observed(report, {"rows": F.count(F.lit(1))}) for name, report in reports.items()}
    together(*[partial(write_csv, df, f"{folder}/{name}", PACKED.get(name)) for name, (df, _) in watched.items()])
    return {name: seen()["rows"] or 0 for name, (_, seen) in watched.items()}


def publish_transactions(fact: DataFrame, metrics: DataFrame, quarantine: DataFrame, folder: str) -> dict[str, int]:
    """Write the reports of a run's tables and return the rows of each.

    The facts given, in as many parts as they have; one row per day and one per reason.
    """
    reports = {
        "fact_transactions.csv": fact.select(*SNAPSHOT_COLUMNS),
        "daily_metrics.csv": latest_metrics(metrics).coalesce(1),
        "quarantine.csv": reject_breakdown(quarantine).coalesce(1),
    }
    return _publish(reports, folder)


def publish_runs(runs: DataFrame, folder: str) -> dict[str, int]:
    """Write the report of the last 30 runs and return its rows."""
    return _publish({"pipeline_runs.csv": recent_runs(runs).select(*RUN_COLUMNS).coalesce(1)}, folder)


def publish_institutions(
    valid: DataFrame, counts: DataFrame, folder: str, generated_at: str, summary: DataFrame | None = None
) -> dict[str, int]:
    """Write the institutions, in as many parts as they have, a one-row metadata file and a summary.

    The rows of the institutions' file are returned.
    """
    published = _publish({"institutions.csv": valid.select(*INSTITUTION.names)}, folder)
    meta = counts.select(
        F.lit(generated_at).alias("generated_at"),
        F.col("valid_rows").alias("institution_count"),
        F.col("rejected_rows").alias("rejected_count"),
    ).select(*INSTITUTION_META.names)
    meta.coalesce(1).write.mode("overwrite").json(f"{folder}/meta.json")
    if summary is not None:
        summary.coalesce(1).write.mode("overwrite").json(f"{folder}/summary.json")
    return published
