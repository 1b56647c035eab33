"""The transaction pipeline, from landed files to published reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reliq import schemas
from reliq.operators import constraints, drift, gates, marts, metrics, quarantine, reconcile, reports, runlog, staging
from reliq.operators.skew import NONE, HotKeys, hot_keys
from reliq.functions.literals import literal_rows
from reliq.functions.together import together
from reliq.sinks.logs import append_log, compact_day, read_log, read_newest
from reliq.sinks.snapshots import publish_runs, publish_transactions
from reliq.sinks.tables import observed, reload_table, sized
from reliq.sinks.upsert import last_upsert, stored_days, upsert_daily_metrics
from reliq.sinks.versions import drop_folder
from reliq.sources.files import arrival, header_columns, land_csv, land_leniently, utc
from reliq.session import brief_shuffles, fresh_dir
from reliq.sources.layers import layer_path, read_layer, stored_columns, stored_version

DAG_ID = "transactions_daily"
NO_KEYS: HotKeys = {}


@dataclass(frozen=True)
class Inputs:
    """Folders or files of the three incoming CSVs."""

    customers: str
    accounts: str
    transactions: str


class Layers:
    """The tables of a pipeline below its root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def raw(self, table: str) -> DataFrame:
        return read_layer(self.spark, self.root, "raw", table)

    def staged(self, table: str) -> DataFrame:
        return read_layer(self.spark, self.root, "staging", table)

    def classified(self) -> DataFrame:
        """Landed transactions once per outcome, partitioned by it."""
        return read_layer(self.spark, self.root, "classified", "transactions")

    def staged_transactions(self, strict: bool = True, carry: Sequence[str] = ()) -> DataFrame:
        """The typed view over the accepted rows; reads one partition."""
        stored = self.classified().withColumnRenamed("recorded_at", "ingested_at")
        return quarantine.loaded_rows(stored, strict, [*carry, "ingested_at"])

    def quarantined(self) -> DataFrame:
        """The rejected rows with their reason; reads the other partitions."""
        stored = self.classified().withColumnRenamed("recorded_at", "rejected_at")
        return quarantine.rejected_rows(stored, ["rejected_at"])

    def damaged(self, table: str = "transactions") -> DataFrame:
        """The lines of a lenient landing that did not fit their table; a strict one has none."""
        return read_layer(self.spark, self.root, "classified", f"damaged_{table}")

    def reject_reasons(self) -> DataFrame:
        """One row per reject, in typed rows and in lines that could not be read: its reason."""
        return self.quarantined().select("reject_reason").unionByName(self.damaged().select("reject_reason"))

    def mart(self, table: str) -> DataFrame:
        return read_layer(self.spark, self.root, "analytics", table)

    def dated_facts(self) -> DataFrame:
        """The facts with the month that they are stored by."""
        return stored_version(self.spark, self.root, "analytics", "fact_transactions")

    @property
    def metrics_path(self) -> str:
        return layer_path(self.root, "analytics", "daily_transaction_metrics")

    def daily_metrics(self) -> DataFrame:
        return stored_days(self.spark, self.metrics_path)

    def latest_facts(self, n: int) -> DataFrame:
        """The newest facts, from the months in which the last run has counted them."""
        return reports.latest_dated_facts(self.dated_facts(), last_upsert(self.spark, self.metrics_path), n)

    def _log(self, table: str):
        return self.spark, layer_path(self.root, "ops", table), schemas.LAYERS["ops"][table]

    def ops(self, table: str) -> DataFrame:
        """A whole audit log."""
        return read_log(*self._log(table))

    def runs(self) -> DataFrame:
        return runlog.run_state(self.ops("run_events"))

    def recent_runs(self, n: int = 30) -> DataFrame:
        """The state of at least the last ``n`` runs, from the days on which they started."""
        events = read_newest(*self._log("run_events"), lambda rows: rows.select("dag_run_id").distinct().count() > n)
        return runlog.run_state(events)

    def snapshots_of(self, tables: Sequence[str]) -> DataFrame:
        """The schema snapshots of some tables, from the newest days that hold two runs of each."""
        own = F.col("table_name").isin(list(tables))

        def enough(rows: DataFrame) -> bool:
            runs = rows.filter(own).groupBy("table_name").agg(F.countDistinct("dag_run_id").alias("runs"))
            return runs.filter("runs > 1").count() == len(tables)

        return read_newest(*self._log("schema_snapshots"), enough).filter(own)

    def audit(self, df: DataFrame, table: str, day: date) -> None:
        """Append to the log of the day on which a run started; many files of it become one."""
        spark, path, layout = self._log(table)
        append_log(df, path, layout, day)
        compact_day(spark, path, layout, day)


def land(spark: SparkSession, inputs: Inputs, layers: Layers, at: datetime | None = None, strict: bool = True) -> dict:
    """Reload the raw layer and return the source totals of the transactions, taken while they are written.

    A strict landing raises on a line that does not fit its table; a lenient one stores it with its text.
    """
    if strict:
        good = {name: land_csv(spark, getattr(inputs, name), name, at) for name in schemas.RAW}
        damaged = {name: spark.createDataFrame([], schemas.DAMAGED) for name in schemas.RAW}
    else:
        landed = {name: land_leniently(spark, getattr(inputs, name), name, at) for name in schemas.RAW}
        good, damaged = ({name: pair[k] for name, pair in landed.items()} for k in range(2))
    # Amounts that are none count nothing here; a strict run raises on them when it types them.
    good["transactions"], source = observed(good["transactions"], reconcile.source_metrics(strict=False))
    damaged["transactions"], lost = observed(damaged["transactions"], {"damaged": F.count(F.lit(1))})
    together(
        *[partial(reload_table, df, layers.root, "raw", name) for name, df in good.items()],
        *[partial(reload_table, df, layers.root, "classified", f"damaged_{name}") for name, df in damaged.items()],
    )
    return {**source(), **lost()}


def find_hot_keys(layers: Layers) -> HotKeys:
    """Hot keys of the landed tables: transaction ids, accounts and customers."""
    transactions, accounts = together(
        partial(hot_keys, layers.raw("transactions"), "transaction_id", "account_id"),
        partial(hot_keys, layers.raw("accounts"), "customer_id"),
    )
    return {**transactions, **accounts}


def stage(layers: Layers, at: datetime | None = None, strict: bool = True, hot: HotKeys = NO_KEYS) -> int:
    """Reload staging, quarantine and account dimension, parents before children; the rejects are returned.

    One join of accounts and customers checks the owners and brings their names. The transactions are
    classified once and written by outcome: the accepted partition is the staging table, the others are
    the quarantine. The join that finds orphans also brings the account context of the fact table.
    """
    customers = staging.stage_customers(layers.raw("customers"), strict)
    reload_table(customers.withColumn("ingested_at", arrival(at)), layers.root, "staging", "customers")
    owners = hot.get("customer_id", NONE)
    known = staging.stg_customers(layers.staged("customers"))
    accounts = marts.dim_account_of_landed(layers.raw("accounts"), known, strict, owners)
    reload_table(accounts, layers.root, "analytics", "dim_account")
    staged = layers.mart("dim_account").select(*schemas.STG_ACCOUNTS.names)
    classified = quarantine.classify_transactions(
        layers.raw("transactions"), layers.mart("dim_account"), strict, hot=hot, carry=marts.ACCOUNT_CONTEXT
    )
    # The rows are stored between their exchanges: those moved to tell copies apart are gone before they are dealt again.
    work = fresh_dir(layers.spark, "classified")
    try:
        classified.write.option("compression", "zstd").parquet(work)
        told = layers.spark.read.schema(classified.schema).parquet(work)
        # The accepted rows are dealt by the month that their facts are stored by.
        month = F.when(F.col("outcome") == quarantine.LOADED, F.substring("transaction_date", 1, 7))
        dealt = sized(told.withColumn("_month", F.hash(month)), "outcome", "_month").drop("_month").withColumn("recorded_at", arrival(at))
        counted, seen = observed(dealt, {"rejects": F.count_if(F.col("outcome") != quarantine.LOADED)})
        together(
            partial(reload_table, staged.withColumn("ingested_at", arrival(at)), layers.root, "staging", "accounts"),
            partial(reload_table, counted, layers.root, "classified", "transactions", partition_by="outcome"),
        )
    finally:
        drop_folder(layers.spark, work)
    return seen()["rejects"] or 0


def model(layers: Layers, strict: bool = True) -> dict:
    """Reload the rest of the star schema and return the target totals, taken while the facts are written.

    The facts need no join any more. They are stored by month and, within its files, by date; the
    accepted rows were dealt by month already, so they are written from the tasks that read them.
    """
    customers = staging.stg_customers(layers.staged("customers"))
    staged = layers.staged_transactions(strict, marts.ACCOUNT_CONTEXT)
    facts = marts.dated_facts(staging.stg_transactions(staged, marts.ACCOUNT_CONTEXT))
    dated = marts.with_month(facts).sortWithinPartitions(schemas.FACT_MONTH, "transaction_date")
    counted, seen = observed(dated, reconcile.target_metrics())
    dimensions = {"dim_customer": marts.dim_customer(customers), "dim_date": marts.dim_date(layers.spark)}
    together(
        partial(reload_table, counted, layers.root, "analytics", "fact_transactions", partition_by=schemas.FACT_MONTH),
        *[partial(reload_table, df, layers.root, "analytics", name) for name, df in dimensions.items()],
    )
    return seen()


def check_marts(layers: Layers) -> None:
    """Run the constraint tests and raise with the names of those that fail."""
    results = constraints.mart_results(
        layers.mart("dim_customer"), layers.mart("dim_account"), layers.mart("fact_transactions")
    )
    failed = [row[0] for row in results.filter("should_error").select("test_name").collect()]
    if failed:
        raise gates.GateFailure(f"Constraint tests failed: {failed}")


def one_row(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Counts of a run as a one-row frame."""
    return spark.range(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in counts.items()])


def check(layers: Layers, checks: DataFrame, run_id: str, at: datetime) -> None:
    """Audit every gate, then fail with all failed names."""
    layers.audit(gates.audit_rows(checks, run_id, arrival(at)), "quality_checks", at.date())
    gates.require_passed(checks)


def reconcile_layers(layers: Layers, source: dict, target: dict, run_id: str, at: datetime) -> None:
    """Audit the three totals of this attempt and judge them alone."""
    known = reconcile.reconcile_values(layers.spark, source, target)
    layers.audit(reconcile.audit_rows(known, run_id, arrival(at)), "reconciliation", at.date())
    reconcile.require_reconciled(known)


def check_drift(layers: Layers, tables: dict[str, DataFrame], run_id: str, at: datetime) -> None:
    """Snapshot the columns of some tables and compare names and types with the run before."""
    taken = [drift.schema_snapshot(df, run_id, name, at) for name, df in tables.items()]
    layers.audit(literal_rows(layers.spark, taken, schemas.SCHEMA_SNAPSHOTS), "schema_snapshots", at.date())
    snapshots = layers.snapshots_of(list(tables))
    drift.require_no_drift(drift.detect_drift(snapshots), drift.type_drift(snapshots))


def measure(layers: Layers, at: datetime | None = None) -> int:
    daily = metrics.daily_metrics(layers.mart("fact_transactions"))
    return upsert_daily_metrics(layers.spark, daily, layers.metrics_path, at)


def publish(layers: Layers, folder: str, facts: int | None = None) -> dict[str, int]:
    """Publish the reports, with all facts or only so many of the newest, and return the rows of each."""
    published = layers.mart("fact_transactions") if facts is None else layers.latest_facts(facts)
    return publish_transactions(published, layers.daily_metrics(), layers.reject_reasons(), folder)


def run_transactions(
    spark: SparkSession,
    inputs: Inputs,
    root: str,
    run_id: str,
    at: datetime | None = None,
    strict: bool = True,
    enforce: bool = True,
    facts: int | None = None,
) -> dict:
    """Run the whole pipeline and return its counts.

    A failure is recorded with its text and raised again; a run is a success once its tables are
    published. With ``enforce`` off, gates, reconciliation and drift are audited but do not stop the run.
    """
    # A step reads what the one before has written, so no shuffle is needed beyond its step.
    with brief_shuffles(spark):
        return _run(spark, inputs, root, run_id, at, strict, enforce, facts)


def _run(
    spark: SparkSession, inputs: Inputs, root: str, run_id: str, at: datetime | None, strict: bool, enforce: bool, facts: int | None
) -> dict:
    layers = Layers(spark, root)
    started = utc(at)
    run = (run_id, DAG_ID)
    layers.audit(runlog.event(spark, run, started), "run_events", started.date())
    sizes: dict[str, int] = {}

    def finish(status: str, error: str | None = None) -> None:
        counts = runlog.Counts(*[sizes.get(name, 0) for name in ("raw_rows", "fact_rows", "quarantined_rows")])
        ended = runlog.event(spark, run, max(utc(), started), status, counts, error)
        layers.audit(ended, "run_events", started.date())

    def guarded(step, *args) -> None:
        try:
            step(*args)
        except gates.GateFailure:
            if enforce:
                raise

    folder = layer_path(root, "snapshots", "transactions")
    try:
        headers = {f"incoming_{name}": header_columns(spark, getattr(inputs, name)) for name in schemas.RAW}
        guarded(check_drift, layers, headers, run_id, started)
        source = land(spark, inputs, layers, started, strict)
        rejects = stage(layers, started, strict, find_hot_keys(layers))
        target = model(layers, strict)
        check_marts(layers)
        damaged = source.pop("damaged") or 0
        sizes["raw_rows"] = (source["transaction_count"] or 0) + damaged
        sizes["fact_rows"] = target["transaction_count"] or 0
        sizes["quarantined_rows"] = rejects + damaged
        guarded(check, layers, gates.transaction_gates(one_row(spark, sizes)), run_id, started)
        guarded(reconcile_layers, layers, source, target, run_id, started)
        stored = {name: stored_columns(spark, root, "raw", name) for name in schemas.RAW}
        guarded(check_drift, layers, stored, run_id, started)
        sizes["metric_days"] = measure(layers, started)
        sizes["published"] = publish(layers, folder, facts)
        finish("success")
        # Only the report of runs comes after: it has to name this one.
        sizes["published"] |= publish_runs(layers.recent_runs(), folder)
    except Exception as error:
        # The last outcome of a run is the one that counts.
        finish("failed", str(error))
        raise
    return sizes
