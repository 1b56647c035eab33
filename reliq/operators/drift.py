"""Schema snapshots and drift against the snapshot of an earlier run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reliq.functions.together import together
from reliq.operators.gates import GateFailure
from reliq.sources.files import utc
from reliq.sources.layers import table_columns


def schema_snapshot(df: DataFrame, run_id: str, table: str, at: datetime | None = None) -> tuple:
    """A snapshot row with the column names of a frame, in order, and their types."""
    return (run_id, table, table_columns(df), utc(at), [field.dataType.simpleString() for field in df.schema.fields])


def snapshot_at_newest_row(df: DataFrame, run_id: str, table: str) -> DataFrame:
    """The snapshot of a landed table, dated by its newest row."""
    names = F.array(*[F.lit(name) for name in df.columns])
    return df.agg(F.max("ingested_at").alias("captured_at")).select(
        F.lit(run_id).alias("dag_run_id"), F.lit(table).alias("table_name"), names.alias("column_names"), "captured_at"
    )


def recent_snapshots(snapshots: DataFrame, keep: int = 2) -> DataFrame:
    """The newest snapshot of each of the last ``keep`` runs of every table, as ``age`` 1 and up.

    A retried run counts once, so it is compared with the run before it.
    """
    newest = F.max(F.struct("captured_at", "column_names")).alias("s")
    per_run = snapshots.groupBy("table_name", "dag_run_id").agg(newest)
    window = Window.partitionBy("table_name").orderBy(F.desc("s.captured_at"), F.desc("dag_run_id"))
    ranked = per_run.withColumn("age", F.row_number().over(window)).filter(F.col("age") <= keep)
    return ranked.select(
        "table_name",
        "dag_run_id",
        F.col("s.captured_at").alias("captured_at"),
        F.col("s.column_names").alias("column_names"),
        "age",
    )


def second_newest(snapshots: DataFrame) -> DataFrame:
    """The newest snapshot of the run before the last, per table."""
    return recent_snapshots(snapshots).filter("age = 2").drop("age")


def detect_drift(snapshots: DataFrame) -> DataFrame:
    """Columns added and removed per table; names count, order does not."""
    pairs = recent_snapshots(snapshots).groupBy("table_name").agg(
        F.max(F.when(F.col("age") == 1, F.col("dag_run_id"))).alias("dag_run_id"),
        F.max(F.when(F.col("age") == 1, F.col("column_names"))).alias("current"),
        F.max(F.when(F.col("age") == 2, F.col("column_names"))).alias("previous"),
    )
    known = F.coalesce("previous", "current")
    added = F.array_sort(F.array_except("current", known))
    removed = F.array_sort(F.array_except(known, F.col("current")))
    return pairs.select(
        "table_name",
        "dag_run_id",
        added.alias("added"),
        removed.alias("removed"),
        ((F.size(added) > 0) | (F.size(removed) > 0)).alias("drift"),
        F.col("previous").isNull().alias("first_run"),
    )


def type_drift(snapshots: DataFrame) -> DataFrame:
    """Columns that both of the last two runs have, with another type now: one row for each.

    Types are compared by column name, so a moved column is none; a snapshot without types, as
    were taken before types were kept, says nothing.
    """
    typed = snapshots.filter("column_types is not null").withColumn(
        "column_names", F.arrays_zip(F.col("column_names").alias("name"), F.col("column_types").alias("kind"))
    )
    pairs = recent_snapshots(typed).select("table_name", "dag_run_id", "age", F.inline("column_names"))

    def of(age: int, column: str) -> Column:
        return F.max(F.when(F.col("age") == age, F.col(column)))

    both = pairs.groupBy("table_name", F.col("name").alias("column_name")).agg(
        of(1, "dag_run_id").alias("dag_run_id"), of(2, "kind").alias("old_type"), of(1, "kind").alias("new_type")
    )
    return both.filter("old_type <> new_type").select("table_name", "dag_run_id", "column_name", "old_type", "new_type")


def require_no_drift(drift: DataFrame, types: DataFrame | None = None) -> None:
    """Raise with all columns that were added, removed or, where given, have changed their type."""
    jobs = [drift.filter("drift").orderBy("table_name").collect]
    if types is not None:
        jobs.append(types.orderBy("table_name", "column_name").collect)
    found, changed = [*together(*jobs), []][:2]
    parts = [f"{r['table_name']}: added={r['added']} removed={r['removed']}" for r in found]
    parts += [f"{r['table_name']}: {r['column_name']} was {r['old_type']}, is {r['new_type']}" for r in changed]
    if parts:
        raise GateFailure("Columns are not those of the last run: " + "; ".join(parts))
