"""The institution pipeline, from landed pages to published files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from reliq.operators import gates, institutions, runlog
from reliq.plans.transactions import Layers, check, one_row
from reliq.sinks.snapshots import publish_institutions
from reliq.sinks.tables import reload_table
from reliq.sources.files import utc
from reliq.sources.layers import layer_path, read_layer
from reliq.sources.pages import fetch_institutions, page_documents, page_sizes, require_complete

DAG_ID = "institutions_daily"


def judged(spark: SparkSession, root: str) -> DataFrame:
    """Stored institutions with their reject reason, null for valid ones."""
    return read_layer(spark, root, "staging", "institutions")


def run_institutions(
    spark: SparkSession,
    pages: str,
    root: str,
    run_id: str,
    at: datetime | None = None,
    multi_line: bool = True,
) -> dict:
    """Run the whole pipeline and return its counts; rejected records are stored as well."""
    layers = Layers(spark, root)
    started = utc(at)
    run = (run_id, DAG_ID)
    layers.audit(runlog.event(spark, run, started), "run_events", started.date())
    sizes: dict[str, int] = {}

    def finish(status: str, error: str | None = None) -> None:
        valid, rejected = (sizes.get(name, 0) for name in ("valid_rows", "rejected_rows"))
        ended = runlog.event(spark, run, max(utc(), started), status, runlog.Counts(valid + rejected, valid, rejected), error)
        layers.audit(ended, "run_events", started.date())

    try:
        require_complete(page_sizes(page_documents(spark, pages, multi_line)))
        reload_table(fetch_institutions(spark, pages, multi_line), root, "raw", "institutions")
        records = institutions.with_reason(layers.raw("institutions"))
        reload_table(records, root, "staging", "institutions")
        sizes.update(institutions.outcome_counts(judged(spark, root)).head().asDict())
        counts = one_row(spark, sizes)
        check(layers, gates.institution_gates(counts), run_id, started)
        publish_institutions(
            institutions.valid_records(judged(spark, root)),
            counts,
            layer_path(root, "snapshots", "institutions"),
            started.isoformat(),
            institutions.summarise(judged(spark, root).drop("_reason"), started),
        )
        finish("success")
    except Exception as error:
        finish("failed", str(error))
        raise
    return sizes
