"""Run log as append-only events; the state of a run is its latest events."""

from __future__ import annotations

from dataclasses import astuple, dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reliq.functions.dates import seconds_between
from reliq.functions.literals import literal_rows
from reliq.operators.topk import first_rows
from reliq.schemas import RUN_EVENTS


@dataclass(frozen=True)
class Counts:
    """What a run has read, kept and rejected so far."""

    extracted: int = 0
    loaded: int = 0
    quarantined: int = 0


def event(
    spark: SparkSession,
    run: tuple[str, str],
    at: datetime,
    status: str = "running",
    counts: Counts = Counts(),
    error: str | None = None,
) -> DataFrame:
    """One row of the log of a ``run`` (its id and that of its pipeline): it starts, or it ends with a status."""
    kind = "started" if status == "running" else "finished"
    return literal_rows(spark, [(*run, kind, at, status, *astuple(counts), error)], RUN_EVENTS)


def run_state(events: DataFrame) -> DataFrame:
    """One row per run: its first start, and its latest finish where there is one."""
    finish = F.struct(
        "event_ts", "status", "records_extracted", "records_loaded", "records_quarantined", "error_message"
    )
    state = events.groupBy("dag_run_id").agg(
        F.min(F.when(F.col("event") == "started", F.struct("event_ts", "dag_id"))).alias("s"),
        F.max(F.when(F.col("event") == "finished", finish)).alias("f"),
    )

    def count(name: str):
        return F.coalesce(F.col(f"f.{name}"), F.lit(0)).cast("bigint").alias(name)

    return state.filter("s is not null").select(
        "dag_run_id",
        F.col("s.dag_id").alias("dag_id"),
        F.col("s.event_ts").alias("started_at"),
        F.col("f.event_ts").alias("finished_at"),
        F.coalesce(F.col("f.status"), F.lit("running")).alias("status"),
        count("records_extracted"),
        count("records_loaded"),
        count("records_quarantined"),
        seconds_between(F.col("s.event_ts"), F.col("f.event_ts")).alias("duration_seconds"),
        F.col("f.error_message").alias("error_message"),
    )


def recent_runs(state: DataFrame, n: int = 30) -> DataFrame:
    """The runs started last."""
    return first_rows(state, [F.desc("started_at"), F.asc("dag_run_id")], n)
