"""The registered queries, by name."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta, timezone
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reliq.functions.together import together
from reliq.operators import (
    constraints,
    dedupe,
    drift,
    gates,
    institutions,
    marts,
    metrics,
    quarantine,
    reconcile,
    reports,
    runlog,
    staging,
)
from reliq.plans.institutions import run_institutions
from reliq.plans.transactions import Inputs, Layers, run_transactions
from reliq.schemas import INSTITUTION_META, RAW, RAW_CUSTOMERS, RAW_TRANSACTIONS
from reliq.session import brief_shuffles, configure, fresh_dir
from reliq.sinks.keyed import KeyedTable
from reliq.sinks.snapshots import publish_transactions, write_csv
from reliq.sinks.tables import reload_table
from reliq.sinks.upsert import stored_days, upsert_daily_metrics
from reliq.sinks.versions import drop_folder, files_of, names_in
from reliq.sources.files import land_csv, land_leniently, load_csv, load_json
from reliq.sources.pages import PAGE_SIZE, fetch_institutions, page_gaps, source_page
from reliq_queries import fixtures
from reliq_queries.fixtures import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

FIXED_TIME = datetime(2024, 1, 1, tzinfo=timezone.utc)
QUERIES: dict[str, Query] = {}


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the parquet tables hold them."""
    moments = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in moments})


def register(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return plain_times(query(spark, sf_dir))

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    QUERIES[query.__name__] = run
    return query


def over_warehouse(name: str, build: Callable[[Warehouse], DataFrame]) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Warehouse(spark, sf_dir))

    query.__name__ = name
    register(query)


def over_institutions(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(institutions.with_reason(fixtures.institutions(spark, sf_dir)))

    query.__name__ = name
    register(query)


GIVEN = ["CERT", "NAME", "STALP", "ASSET", "BKCLASS"]

over_warehouse("staging_customers", lambda w: w.customers())
over_warehouse("staging_accounts", lambda w: w.accounts())
over_warehouse("staging_transactions", lambda w: w.transactions())
over_warehouse("stg_customers_view", lambda w: staging.stg_customers(w.customers()))
over_warehouse("stg_accounts_view", lambda w: staging.stg_accounts(w.accounts()))
over_warehouse("stg_transactions_view", lambda w: staging.stg_transactions(w.transactions()))

over_warehouse("quarantine_transactions", lambda w: w.quarantine())
over_warehouse("quarantine_negative", lambda w: quarantine.negative_amounts(w.raw("transactions")))
over_warehouse(
    "quarantine_orphans",
    lambda w: quarantine.orphan_transactions(w.raw("transactions"), w.accounts(), w.hot_values("account_id")),
)
over_warehouse(
    "quarantine_duplicates",
    lambda w: quarantine.duplicate_transactions(w.raw("transactions"), hot=w.hot_values("transaction_id")),
)
over_warehouse("quarantine_breakdown", lambda w: reports.reject_breakdown(w.quarantine()))
over_warehouse(
    "quarantine_counts", lambda w: quarantine.count_by_reason(w.raw("transactions"), w.accounts())
)

over_warehouse("dim_customer", lambda w: w.dim_customer())
over_warehouse("dim_account", lambda w: w.dim_account())
over_warehouse("dim_date", lambda w: marts.dim_date_covering(w.fact()))
over_warehouse("fact_transactions", lambda w: w.fact())

over_warehouse("daily_transaction_metrics", lambda w: metrics.daily_metrics(w.fact()))
over_warehouse("latest_daily_metrics", lambda w: reports.latest_metrics(metrics.daily_metrics(w.fact()), 10))
over_warehouse("daily_value_trend", lambda w: reports.value_trend(metrics.daily_metrics(w.fact())))

over_warehouse("test_unique", lambda w: constraints.unique(w.raw("transactions"), "transaction_id"))
over_warehouse(
    "test_not_null",
    lambda w: constraints.scan_results(w.raw("customers"), "raw_customers", ["full_name", "customer_id"]),
)
over_warehouse(
    "test_accepted_values",
    lambda w: constraints.accepted_values(w.raw("accounts"), "currency", ["EUR", "USD"]),
)
over_warehouse(
    "test_relationships",
    lambda w: constraints.relationships(
        w.raw("transactions"), w.accounts(), "account_id", hot=w.hot_values("account_id")
    ),
)
over_warehouse(
    "reconciliation", lambda w: reconcile.reconcile_totals(w.raw("transactions"), w.fact())
)
over_warehouse("status_counts", lambda w: reports.status_counts(w.fact()))
over_warehouse("country_rollup", lambda w: reports.country_rollup(w.fact(), w.dim_customer()))
over_warehouse("latest_facts", lambda w: reports.latest_facts(w.fact()))

over_institutions("institutions_valid", lambda r: institutions.valid_records(r).select(*GIVEN))
over_institutions("institutions_rejected", lambda r: institutions.rejected_records(r).select(*GIVEN, "_reason"))
over_institutions("institutions_reject_counts", institutions.reason_counts)
over_institutions("institutions_summary", lambda r: institutions.summarise(r.drop("_reason"), FIXED_TIME))
over_institutions(
    "institution_quality_checks", lambda r: gates.institution_gates(institutions.outcome_counts(r))
)
over_institutions("institution_kpis", lambda r: institutions.kpis(institutions.valid_records(r)))
over_institutions("institutions_top20", lambda r: institutions.top_by_assets(institutions.valid_records(r)))
over_institutions(
    "institutions_display",
    lambda r: institutions.display(institutions.valid_records(r).select("ASSET", "STALP", "NAME", "BKCLASS", "CERT")),
)
over_institutions("institutions_by_state", lambda r: institutions.by_state(institutions.valid_records(r)))


@register
def insert_ignore_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts a target that already holds those in EUR would take in."""
    w = Warehouse(spark, sf_dir)
    target = w.accounts().filter("currency = 'EUR'")
    incoming = w.accounts()
    order = staging.copy_order("customer_id", "account_type", "currency", "opened_date")[1:]
    return dedupe.insert_ignore(target, incoming, "account_id", order)


@register
def insert_new_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table after two loads: the accounts in EUR, then all of them, of which it takes the new ones."""
    incoming = Warehouse(spark, sf_dir).accounts()
    order = staging.copy_order("customer_id", "account_type", "currency", "opened_date")[1:]
    name = f"accounts_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    target = KeyedTable(spark, name, f"{fresh_dir(spark, 'keyed')}/accounts", "account_id", buckets)
    target.insert_new(incoming.filter("currency = 'EUR'"), order)
    target.insert_new(incoming, order)
    stored = spark.read.schema(incoming.schema).parquet(target.path)
    spark.sql(f"drop table {name}")
    return stored


@register
def quarantine_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantine of a lenient load, where some amounts and dates are damaged."""
    w = Warehouse(spark, sf_dir)
    amount = F.col("amount")
    damaged = w.raw("transactions").withColumns(
        {
            "amount": F.when(amount.like("%.13"), "n/a").when(~amount.like("%.17"), amount),
            "transaction_date": F.when(
                (F.col("merchant") == "Brand#7") & amount.like("%.5_"), "soon"
            ).otherwise(F.col("transaction_date")),
        }
    )
    return quarantine.quarantine_transactions(damaged, w.accounts(), strict=False, tag_missing=True, hot=w.hot)


@register
def daily_metrics_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored metrics table after a second run: late days are rewritten, early ones stay."""
    path = fresh_dir(spark, "metrics")
    daily = metrics.daily_metrics(Warehouse(spark, sf_dir).fact())
    daily = spark.read.schema(daily.schema).parquet(reload_table(daily, path, "work", "daily"))
    late = F.col("metric_date") >= F.lit("1998-01-15").cast("date")
    before = daily.withColumn("active_accounts", F.when(late, 0).otherwise(F.col("active_accounts")))
    upsert_daily_metrics(spark, before, f"{path}/daily_transaction_metrics", FIXED_TIME)
    upsert_daily_metrics(spark, daily.filter(late), f"{path}/daily_transaction_metrics", FIXED_TIME)
    return stored_days(spark, f"{path}/daily_transaction_metrics").drop("updated_at")


def saved_marts(spark: SparkSession, sf_dir: str) -> Layers:
    """The star schema of the driver tables, written to a fresh folder."""
    w, root = Warehouse(spark, sf_dir), fresh_dir(spark, "marts")
    layers = Layers(spark, root)
    dimensions = {"dim_customer": w.dim_customer(), "dim_account": w.dim_account()}
    together(*[partial(reload_table, df, root, "analytics", name) for name, df in dimensions.items()])
    transactions = staging.stg_transactions(w.transactions())
    fact = marts.fact_transactions(transactions, layers.mart("dim_account"), w.hot_values("account_id"))
    reload_table(fact, root, "analytics", "fact_transactions")
    return layers


@register
def test_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine constraint tests of the stored star schema."""
    layers = saved_marts(spark, sf_dir)
    return constraints.mart_results(
        layers.mart("dim_customer"), layers.mart("dim_account"), layers.mart("fact_transactions")
    )


@register
def test_summary_of_damage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine tests over marts with doubled and missing keys, odd statuses, lost accounts and amounts."""
    w = Warehouse(spark, sf_dir)

    def damaged_keys(df: DataFrame, key: str) -> DataFrame:
        column = F.col(key)
        doubled = df.select(key).unionByName(df.select(key).filter(column.like("%7")))
        return doubled.select(F.when(~column.like("%3"), column).alias(key))

    fact = w.fact()
    doubled = fact.unionByName(fact.filter(F.col("transaction_id").like("%-2")))
    merchant = F.col("merchant")
    damaged = doubled.withColumns(
        {
            "transaction_id": F.when(~F.col("transaction_id").like("%-3"), F.col("transaction_id")),
            "account_id": F.when(F.col("account_id").like("%1"), "none").otherwise(F.col("account_id")),
            "amount": F.when(merchant != "Brand#5", F.col("amount")),
            "status": F.when(merchant.like("%3"), merchant).otherwise(F.col("status")),
        }
    )
    return constraints.mart_results(
        damaged_keys(w.dim_customer(), "customer_id"), damaged_keys(w.dim_account(), "account_id"), damaged
    )


def _classified(w: Warehouse) -> DataFrame:
    """The landed transactions, classified once, with the account context of the facts."""
    return quarantine.classify_transactions(w.raw("transactions"), w.dim_account(), hot=w.hot, carry=marts.ACCOUNT_CONTEXT)


def _counted(w: Warehouse) -> DataFrame:
    """The sizes that the gates look at: one classification, and the landed rows."""
    totals = reports.classified_totals(_classified(w))
    sizes = totals.select(F.col("transactions").alias("fact_rows"), F.col("quarantined").alias("quarantined_rows"))
    return reports.side_by_side(w.raw("transactions").agg(F.count("*").alias("raw_rows")), sizes)


over_warehouse("quality_checks", lambda w: gates.transaction_gates(_counted(w)))
over_warehouse(
    "fact_kpis",
    lambda w: reports.classified_totals(_classified(w)),
)


@register
def reconciliation_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The variance rule on every day: landed positive value against modelled value."""
    w = Warehouse(spark, sf_dir)
    amount = F.col("amount").cast("decimal(18,2)")
    value = F.coalesce(F.sum(F.when(amount > 0, amount)), F.lit(0)).cast(reconcile.VALUE)
    source = w.raw("transactions").groupBy(F.substring("transaction_date", 1, 10).alias("metric_name"))
    target = w.fact().groupBy(F.col("transaction_date").cast("string").alias("metric_name"))
    pairs = source.agg(value.alias("source_value")).join(
        target.agg(F.sum("amount").cast(reconcile.VALUE).alias("target_value")), "metric_name", "left"
    )
    return reconcile.with_variance(pairs.fillna({"target_value": 0}))


@register
def schema_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of each landed table, dated by its newest row."""
    w = Warehouse(spark, sf_dir)
    taken = [drift.snapshot_at_newest_row(w.raw(name), "raw", name) for name in RAW]
    snapshots = taken[0].unionByName(taken[1]).unionByName(taken[2])
    return snapshots.withColumn("column_names", F.array_join("column_names", ","))


@register
def second_newest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    older = drift.second_newest(fixtures.schema_history(spark, sf_dir))
    return older.withColumn("column_names", F.array_join("column_names", ","))


@register
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drift.detect_drift(fixtures.schema_history(spark, sf_dir))
    return found.withColumns({name: F.array_join(name, ",") for name in ("added", "removed")})


@register
def schema_type_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns whose type is not that of the run before, over all tables."""
    return drift.type_drift(fixtures.schema_history(spark, sf_dir))


@register
def run_log_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.run_state(fixtures.run_events(spark, sf_dir))


@register
def recent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.recent_runs(runlog.run_state(fixtures.run_events(spark, sf_dir)))


@register
def institution_page_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What pages of which some are lost or short leave out of their source."""
    return page_gaps(fixtures.torn_pages(spark, sf_dir))


def landed_pages(spark: SparkSession, sf_dir: str) -> str:
    """Page documents in the shared folder, one per line."""
    path = f"{fresh_dir(spark, 'pages')}/pages"
    fixtures.institution_pages(spark, sf_dir).write.json(path)
    return path


@register
def institutions_second_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page of the source."""
    return source_page(fixtures.institutions(spark, sf_dir), PAGE_SIZE, offset=PAGE_SIZE).select(*GIVEN)


@register
def institutions_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = landed_pages(spark, sf_dir)
    return fetch_institutions(spark, path, multi_line=False).select(*GIVEN)


def landed_inputs(spark: SparkSession, sf_dir: str, clean: bool = False) -> Inputs:
    """The three incoming CSVs in the shared folder."""
    w, root = Warehouse(spark, sf_dir, clean), fresh_dir(spark, "incoming")
    frames = {name: w.raw(name).drop("ingested_at") for name in RAW}
    with brief_shuffles(spark):
        together(*[partial(write_csv, df, f"{root}/{name}.csv", "gzip") for name, df in frames.items()])
    return Inputs(*[f"{root}/{name}.csv" for name in RAW])


@register
def csv_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions written as CSV and landed again."""
    path = f"{fresh_dir(spark, 'incoming')}/transactions.csv"
    write_csv(Warehouse(spark, sf_dir).raw("transactions").drop("ingested_at"), path)
    return land_csv(spark, path, "transactions", FIXED_TIME).drop("ingested_at")


def _text_file(lines: DataFrame, path: str, header: list[str]) -> str:
    """Lines as they are, below a header in each file: written as the one column of a table."""
    lines.select(F.col("value").alias(",".join(header))).write.csv(path, header=True, sep="\x01", quote="\x00", emptyValue="")
    return path


@register
def damaged_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a lenient landing makes of lines that do not fit: the rest, and their text with a reason."""
    lines = fixtures.damaged_lines(spark, sf_dir)
    path = _text_file(lines, f"{fresh_dir(spark, 'incoming')}/transactions.csv", RAW_TRANSACTIONS.names)
    good, damaged = land_leniently(spark, path, "transactions", FIXED_TIME)
    landed = good.select(F.lit("landed").alias("outcome"), F.concat_ws(",", *RAW_TRANSACTIONS.names).alias("record"), F.col("transaction_id").alias("first_field"))
    return landed.unionByName(damaged.select(F.col("reject_reason").alias("outcome"), "record", "first_field"))


def _copied(spark: SparkSession, folder: str, to: str, share: float) -> str:
    """The first bytes of the one file of a folder, as a file."""
    files, place = files_of(spark, names_in(spark, f"{folder}/part-*")[0])
    source, target = files.open(place), files.create(files_of(spark, to)[1])
    target.write(source.readNBytes(int(files.getFileStatus(place).getLen() * share)))
    target.close()
    source.close()
    return to


@register
def tolerant_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published CSV, together with broken ones, of which nothing is read: one that does not exist, one
    whose lines lack fields, an archive that is cut, one that is none, and an empty file."""
    root = fresh_dir(spark, "reports")
    customers = Warehouse(spark, sf_dir).raw("customers").drop("ingested_at")
    write_csv(customers, f"{root}/customers.csv")
    stored = spark.read.schema(RAW_CUSTOMERS).csv(f"{root}/customers.csv", header=True, escape='"')
    _text_file(stored.select(F.concat_ws(",", "customer_id", "full_name").alias("value")), f"{root}/short.csv", RAW_CUSTOMERS.names)
    stored.coalesce(1).write.csv(f"{root}/packed", header=True, compression="gzip")
    stored.coalesce(1).write.csv(f"{root}/plain", header=True)
    _copied(spark, f"{root}/packed", f"{root}/cut.csv.gz", 0.7)
    _copied(spark, f"{root}/plain", f"{root}/none.csv.gz", 1)
    _copied(spark, f"{root}/plain", f"{root}/empty.csv", 0)
    found = [load_csv(spark, f"{root}/customers.csv", RAW_CUSTOMERS)]
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        found += [load_csv(spark, f"{root}/{name}", RAW_CUSTOMERS) for name in ("absent.csv", "short.csv", "cut.csv.gz", "none.csv.gz", "empty.csv")]
    return reduce(DataFrame.unionByName, found)


@register
def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest published facts, read back from their CSV."""
    layers = saved_marts(spark, sf_dir)
    w, fact = Warehouse(spark, sf_dir), layers.mart("fact_transactions")
    folder = f"{layers.root}/snapshots"
    days = metrics.daily_metrics(fact).withColumn("updated_at", F.lit(FIXED_TIME))
    publish_transactions(reports.latest_facts(fact), days, w.quarantine(), folder)
    return spark.read.csv(f"{folder}/fact_transactions.csv", header=True, escape='"')


def _last_run(layers: Layers) -> DataFrame:
    return layers.runs().select("status", "records_extracted", "records_loaded", "records_quarantined")


@register
def transactions_full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logged outcome of the whole transaction run over clean inputs."""
    root = fresh_dir(spark, "run")
    run_transactions(spark, landed_inputs(spark, sf_dir, clean=True), root, "first", FIXED_TIME)
    return _last_run(Layers(spark, root))


@register
def institutions_full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logged outcome of the whole institution run."""
    root = fresh_dir(spark, "run")
    run_institutions(spark, landed_pages(spark, sf_dir), root, "first", FIXED_TIME, multi_line=False)
    return _last_run(Layers(spark, root))


_RUNS: dict[tuple[str, str, str], tuple[str, dict]] = {}


def _once(spark: SparkSession, sf_dir: str, kind: str, run: Callable[[str], dict]) -> tuple[Layers, dict]:
    """The layers that one whole run has stored and what it returned; made once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _RUNS:
        root = fresh_dir(spark, "run")
        _RUNS[key] = (root, run(root))
    root, returned = _RUNS[key]
    return Layers(spark, root), returned


def stored_run(spark: SparkSession, sf_dir: str) -> tuple[Layers, dict]:
    """A transaction run over the defective inputs."""
    def run(root: str) -> dict:
        return run_transactions(spark, landed_inputs(spark, sf_dir), root, "first", FIXED_TIME, enforce=False)

    return _once(spark, sf_dir, "transactions", run)


def stored_institutions(spark: SparkSession, sf_dir: str) -> tuple[Layers, dict]:
    def run(root: str) -> dict:
        return run_institutions(spark, landed_pages(spark, sf_dir), root, "first", FIXED_TIME, multi_line=False)

    return _once(spark, sf_dir, "institutions", run)


def over_run(name: str, build: Callable[[Layers], DataFrame], stored=stored_run) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(stored(spark, sf_dir)[0])

    query.__name__ = name
    register(query)


def published(run: Layers, name: str) -> DataFrame:
    return run.spark.read.csv(f"{run.root}/snapshots/{name}", header=True, escape='"')


def _joined(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.array_join(name, ",") for name in names})


over_run("run_fact", lambda run: run.mart("fact_transactions"))
over_run("run_dim_account", lambda run: run.mart("dim_account"))
over_run("run_staged_accounts", lambda run: run.staged("accounts").drop("ingested_at"))
over_run("run_quarantine", lambda run: run.quarantined().drop("rejected_at"))
over_run("run_daily_metrics", lambda run: run.daily_metrics().drop("updated_at"))
over_run("run_latest_facts", lambda run: run.latest_facts(reports.FACT_SNAPSHOT_ROWS))
over_run("run_kpis", lambda run: reports.fact_kpis(run.mart("fact_transactions"), reports.reject_breakdown(run.quarantined())))
over_run(
    "layer_row_counts",
    lambda run: reports.layer_row_counts(
        run.raw("transactions"),
        run.staged_transactions(),
        run.mart("fact_transactions"),
        reports.reject_breakdown(run.quarantined()),
    ),
)
over_run("run_quality_checks", lambda run: run.ops("quality_checks").drop("dag_run_id", "message", "checked_at"))
over_run("run_reconciliation", lambda run: run.ops("reconciliation").drop("dag_run_id", "checked_at"))
over_run("run_schema_snapshots", lambda run: _joined(run.ops("schema_snapshots"), "column_names", "column_types").drop("captured_at"))
over_run("run_published_rejects", lambda run: published(run, "transactions/quarantine.csv"))
over_run("run_published_metrics", lambda run: published(run, "transactions/daily_metrics.csv").drop("updated_at"))
over_run(
    "run_published_runs",
    lambda run: published(run, "transactions/pipeline_runs.csv").drop("started_at", "finished_at", "duration_seconds"),
)
over_run("published_institutions", lambda run: published(run, "institutions/institutions.csv"), stored_institutions)


@register
def run_counts_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run reports of the files it has published."""
    return spark.createDataFrame(list(stored_run(spark, sf_dir)[1]["published"].items()), "file string, row_count bigint")


@register
def published_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata file of an institution run, together with one that does not exist."""
    root = stored_institutions(spark, sf_dir)[0].root
    found = [load_json(spark, f"{root}/snapshots/institutions/{name}.json") for name in ("meta", "absent")]
    return spark.createDataFrame([meta for meta in found if meta], INSTITUTION_META)


@register
def refused_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of three runs that are stopped: by a gate, by totals that are too far apart and by a new header."""
    root, w = fresh_dir(spark, "run"), Warehouse(spark, sf_dir, clean=True)
    clean = {name: f"{root}/incoming/{name}.csv" for name in [*RAW, "drifted"]}
    accounts = w.raw("accounts").drop("ingested_at")
    # Every twentieth transaction once more, a hundred times as large: copies that are dropped.
    rows = w.raw("transactions").drop("ingested_at")
    copied = F.crc32(F.col("transaction_id").cast("binary")) % 20 == 0
    large = (F.col("amount").cast("decimal(18,2)") * 100).cast("decimal(18,2)").cast("string")
    amounts = F.when(copied, F.array(F.col("amount"), large)).otherwise(F.array("amount"))
    frames = {
        "customers": w.raw("customers").drop("ingested_at"),
        "accounts": accounts,
        "transactions": rows.withColumn("amount", F.explode(amounts)),
        "drifted": accounts.withColumnRenamed("currency", "unit"),
    }
    totals = Inputs(*[clean[name] for name in RAW])

    def clean_inputs() -> Inputs:
        with brief_shuffles(spark):
            together(*[partial(write_csv, df, clean[name], "gzip") for name, df in frames.items()])
        return totals

    # Inputs are landed for the run that takes them, and those of the first go with it.
    # The last run is stopped by a header, before it lands a row.
    runs = {
        "rejects": partial(landed_inputs, spark, sf_dir),
        "totals": clean_inputs,
        "header": partial(replace, totals, accounts=clean["drifted"]),
    }
    for i, (name, inputs) in enumerate(runs.items()):
        landed = inputs()
        try:
            run_transactions(spark, landed, root, name, FIXED_TIME + timedelta(days=i))
        except gates.GateFailure:
            pass
        if name == "rejects":
            drop_folder(spark, landed.transactions.rsplit("/", 1)[0])
    return Layers(spark, root).runs().select("dag_run_id", "status", "records_extracted", "error_message")
