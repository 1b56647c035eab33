"""Whole runs in a scratch folder."""

import datetime as dt
import json
import time
from collections import Counter
from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql import functions as F

from reliq.operators import gates
from reliq.plans.institutions import run_institutions
from reliq.plans.transactions import Inputs, Layers, check_drift, run_transactions
from reliq.schemas import FACT_TRANSACTIONS, INSTITUTION
from reliq.session import shared_dir
from reliq.sinks.tables import reload_table, sized
from reliq.sources import layers as layers_module
from reliq.sources.layers import stored_columns
from reliq_queries import registry

MORNING = dt.datetime(2024, 6, 1, 2, tzinfo=dt.timezone.utc)


def write_inputs(folder, transactions, header="transaction_id,account_id,transaction_date,amount,currency,status,merchant"):
    folder.mkdir(exist_ok=True)
    (folder / "customers.csv").write_text(
        "customer_id,full_name,email,country,signup_date\nc1,Ann,a@x,EE,2024-01-01\nc2,,b@x,LV,2024-01-02\n"
    )
    (folder / "accounts.csv").write_text(
        "account_id,customer_id,account_type,currency,opened_date\na1,c1,checking,EUR,2024-02-01\na2,c2,savings,EUR,2024-02-01\n"
    )
    (folder / "transactions.csv").write_text("\n".join([header, *transactions]) + "\n")
    return Inputs(*[str(folder / f"{name}.csv") for name in ("customers", "accounts", "transactions")])


def line(i, account="a1", amount="10.00", day=1):
    return f"t{i},{account},2024-05-{day:02d} 10:00:00,{amount},EUR,success,shop"


GOOD = [line(i, day=1 + i % 3) for i in range(40)]


def test_a_run_fills_every_layer_and_can_be_repeated(spark, tmp_path):
    inputs, root = write_inputs(tmp_path / "in", [*GOOD, line(0), line("x", amount="-1")]), str(tmp_path / "out")
    layers = Layers(spark, root)
    for attempt in range(2):
        sizes = run_transactions(spark, inputs, root, f"run{attempt}", MORNING + dt.timedelta(days=attempt))
        published = sizes.pop("published")
        assert sizes == {"raw_rows": 42, "fact_rows": 40, "quarantined_rows": 2, "metric_days": 3}
        assert published == {
            "fact_transactions.csv": 40,
            "daily_metrics.csv": 3,
            "quarantine.csv": 2,
            "pipeline_runs.csv": attempt + 1,
        }
        assert rows(layers.staged("customers"), "customer_id") == [("c1",)]
        assert layers.staged_transactions().columns[-1] == "ingested_at"
        assert rows(layers.quarantined(), "transaction_id", "reject_reason") == [
            ("t0", "duplicate_transaction_id"),
            ("tx", "negative_amount"),
        ]
        assert layers.quarantined().columns[-1] == "rejected_at"
        assert layers.daily_metrics().count() == 3
        assert sum(r[0] for r in rows(layers.daily_metrics(), "total_transactions")) == 40
    assert layers.mart("dim_date").count() == 1461
    assert rows(layers.runs(), "dag_run_id", "status", "records_extracted", "records_loaded", "records_quarantined") == [
        ("run0", "success", 42, 40, 2),
        ("run1", "success", 42, 40, 2),
    ]
    assert layers.ops("quality_checks").count() == 6
    assert layers.ops("reconciliation").filter("status = 'ok'").count() == 6
    assert layers.ops("schema_snapshots").count() == 12
    published = {
        name: spark.read.csv(f"{root}/snapshots/transactions/{name}.csv", header=True)
        for name in ("fact_transactions", "daily_metrics", "quarantine", "pipeline_runs")
    }
    assert {name: df.count() for name, df in published.items()} == {
        "fact_transactions": 40,
        "daily_metrics": 3,
        "quarantine": 2,
        "pipeline_runs": 2,
    }
    assert published["daily_metrics"].head()["updated_at"] == "2024-06-02 02:00:00.000000+00:00"


def shuffled_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def test_a_run_leaves_no_shuffled_files(spark, tmp_path):
    before = shuffled_files(spark)
    run_transactions(spark, write_inputs(tmp_path / "in", GOOD), str(tmp_path / "out"), "r1", MORNING)
    until = time.time() + 20
    while shuffled_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled_files(spark) - before
    # Nor what it has stored between two steps.
    assert not list((Path(shared_dir(spark)) / "reliq").glob("classified-*"))


def test_the_inputs_of_a_refused_run_go_with_it(spark):
    folder = Path(shared_dir(spark)) / "reliq"
    before = set(folder.glob("incoming-*"))
    assert registry.QUERIES["refused_runs"](spark, "/root/testdata/sf0.001").count() == 3
    assert set(folder.glob("incoming-*")) <= before


def test_a_failed_gate_is_audited_and_recorded(spark, tmp_path):
    inputs, root = write_inputs(tmp_path / "in", [*GOOD[:5], *[line(i, "a2") for i in range(100, 110)]]), str(tmp_path / "out")
    with pytest.raises(gates.GateFailure, match="reject_rate_below_10pct"):
        run_transactions(spark, inputs, root, "bad", MORNING)
    layers = Layers(spark, root)
    run = layers.runs().head()
    assert (run["status"], run["records_quarantined"]) == ("failed", 10)
    assert "raw_to_fact_reasonable" in run["error_message"]
    assert rows(layers.ops("quality_checks"), "check_status") == [("failed",), ("failed",), ("passed",)]
    run_transactions(spark, inputs, root, "waved through", MORNING, enforce=False)
    assert layers.runs().filter("status = 'success'").count() == 1


def test_a_mended_run_passes_under_the_same_id(spark, tmp_path):
    copies = [*GOOD[:10], *[line(i % 10, day=1 + i % 3) for i in range(30)]]
    inputs, root = write_inputs(tmp_path / "in", copies), str(tmp_path / "out")
    run_transactions(spark, inputs, root, "again", MORNING, enforce=False)
    layers = Layers(spark, root)
    assert "failed" in [r[0] for r in rows(layers.ops("reconciliation"), "status")]
    run_transactions(spark, write_inputs(tmp_path / "in", GOOD), root, "again", MORNING + dt.timedelta(hours=1))
    assert layers.ops("reconciliation").count() == 6
    assert rows(layers.runs(), "dag_run_id", "status") == [("again", "success")]


def test_a_new_stored_column_is_drift(spark, tmp_path):
    inputs, root = write_inputs(tmp_path / "in", GOOD), str(tmp_path / "out")
    run_transactions(spark, inputs, root, "r1", MORNING)
    changed = stored_columns(spark, root, "raw", "accounts").selectExpr("*", "1 as unexpected")
    reload_table(changed, root, "raw", "accounts")
    with pytest.raises(gates.GateFailure, match=r"accounts: added=\['unexpected'\] removed=\[\]"):
        check_drift(Layers(spark, root), {"accounts": stored_columns(spark, root, "raw", "accounts")}, "r2", MORNING + dt.timedelta(days=1))


def test_a_new_stored_type_is_drift(spark, tmp_path):
    inputs, root = write_inputs(tmp_path / "in", GOOD), str(tmp_path / "out")
    run_transactions(spark, inputs, root, "r1", MORNING)
    changed = stored_columns(spark, root, "raw", "transactions").withColumn("amount", F.col("amount").cast("double"))
    with pytest.raises(gates.GateFailure, match="transactions: amount was string, is double"):
        check_drift(Layers(spark, root), {"transactions": changed}, "r2", MORNING + dt.timedelta(days=9))


def test_a_lenient_run_quarantines_damaged_lines(spark, tmp_path):
    inputs, root = write_inputs(tmp_path / "in", [*GOOD, "cut,a1", line("long") + ",more", line("x", amount="-1")]), str(tmp_path / "out")
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST"):
        run_transactions(spark, inputs, root, "strict", MORNING)
    sizes = run_transactions(spark, inputs, root, "lenient", MORNING, strict=False)
    assert (sizes["raw_rows"], sizes["fact_rows"], sizes["quarantined_rows"]) == (43, 40, 3)
    layers = Layers(spark, root)
    assert rows(layers.damaged(), "record") == [("cut,a1",), (line("long") + ",more",)]
    assert rows(spark.read.csv(f"{root}/snapshots/transactions/quarantine.csv", header=True)) == [("damaged_record", "2"), ("negative_amount", "1")]


def test_a_run_reads_its_tables_few_times(spark, tmp_path):
    """Landed rows are read for hot keys and to classify them; facts for tests, metrics and reports."""
    inputs, root = write_inputs(tmp_path / "in", GOOD), str(tmp_path / "out")
    read = []
    real = layers_module.stored_version

    def counted(spark, root, layer, table):
        read.append((layer, table))
        return real(spark, root, layer, table)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(layers_module, "stored_version", counted)
        run_transactions(spark, inputs, root, "r1", MORNING)
    assert read.count(("raw", "transactions")) == 2
    assert read.count(("analytics", "fact_transactions")) == 3


def test_outcomes_are_written_in_files_bounded_by_bytes(spark):
    from test_shapes import plan

    many = spark.range(1000).selectExpr("id", "if(id % 9 = 0, 'bad', 'loaded') as outcome").repartition(50)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(sized(many, "outcome"))


def test_outcomes_make_few_files(spark, tmp_path):
    inputs, root = write_inputs(tmp_path / "in", [*GOOD, line(0), line("x", amount="-1")]), str(tmp_path / "out")
    run_transactions(spark, inputs, root, "r1", MORNING)
    for folder in ("classified/transactions", "analytics/fact_transactions"):
        per_value = Counter(f.parent.name for f in (tmp_path / "out" / folder).rglob("part-*.parquet"))
        assert per_value and set(per_value.values()) == {1}


def test_facts_are_stored_by_month_and_read_by_it(spark, tmp_path):
    inputs, root = write_inputs(tmp_path / "in", GOOD), str(tmp_path / "out")
    run_transactions(spark, inputs, root, "r1", MORNING, facts=5)
    layers = Layers(spark, root)
    assert (tmp_path / "out/analytics/fact_transactions/version-000000000001/transaction_month=2024-05-01").is_dir()
    assert layers.mart("fact_transactions").columns == FACT_TRANSACTIONS.names
    assert layers.latest_facts(5).count() == 5
    assert spark.read.csv(f"{root}/snapshots/transactions/fact_transactions.csv", header=True).count() == 5
    text = layers.latest_facts(5)._sc._jvm.PythonSQLUtils.explainString(layers.latest_facts(5)._jdf.queryExecution(), "simple")
    assert "PartitionFilters: [isnotnull(transaction_month" in text


def test_a_malformed_amount_aborts_a_strict_run_only(spark, tmp_path):
    inputs, root = write_inputs(tmp_path / "in", [*GOOD, line("bad", amount="ten")]), str(tmp_path / "out")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_transactions(spark, inputs, root, "strict", MORNING)
    layers = Layers(spark, root)
    assert rows(layers.runs(), "status") == [("failed",)]
    run_transactions(spark, inputs, root, "lenient", MORNING, strict=False)
    assert rows(layers.quarantined(), "transaction_id", "reject_reason") == [("tbad", "malformed_amount")]


def test_a_new_header_is_reported_as_drift(spark, tmp_path):
    root = str(tmp_path / "out")
    run_transactions(spark, write_inputs(tmp_path / "in", GOOD), root, "r1", MORNING)
    renamed = "transaction_id,account_id,transaction_date,value,currency,status,merchant"
    changed = write_inputs(tmp_path / "in", GOOD, renamed)
    with pytest.raises(gates.GateFailure, match=r"incoming_transactions: added=\['value'\] removed=\['amount'\]"):
        run_transactions(spark, changed, root, "r2", MORNING + dt.timedelta(days=1))


def test_institution_runs(spark, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    made = [dict(CERT=i, NAME=f"bank {i}", STALP="NY", ASSET=float(i), ACTIVE=1) for i in range(105)]
    (folder / "page0.json").write_text(json.dumps({"data": [{"data": m} for m in made], "meta": {"total": 105}}, indent=1))
    root = str(tmp_path / "out")
    assert run_institutions(spark, str(folder), root, "r1", MORNING) == {"valid_rows": 104, "rejected_rows": 1}
    layers = Layers(spark, root)
    assert rows(layers.runs(), "dag_id", "status", "records_loaded") == [("institutions_daily", "success", 104)]
    published = spark.read.csv(f"{root}/snapshots/institutions/institutions.csv", header=True)
    assert published.columns == INSTITUTION.names and published.count() == 104
    meta = spark.read.json(f"{root}/snapshots/institutions/meta.json").head()
    assert (meta["generated_at"], meta["institution_count"], meta["rejected_count"]) == ("2024-06-01T02:00:00+00:00", 104, 1)
    (folder / "page0.json").write_text(json.dumps({"data": [{"data": m} for m in made[:50]], "meta": {"total": 50}}))
    with pytest.raises(gates.GateFailure, match="at_least_100_institutions"):
        run_institutions(spark, str(folder), root, "r2", MORNING + dt.timedelta(days=1))
    assert rows(layers.runs(), "dag_run_id", "status") == [("r1", "success"), ("r2", "failed")]


def test_a_run_moves_and_writes_little(spark, tmp_path):
    """Amounts are parsed behind the exchange on the id; tables and the report of facts are packed."""
    from helpers import accounts_frame, landed, transaction
    from test_shapes import plan

    from reliq.operators.quarantine import classify_transactions

    text = plan(classify_transactions(landed(spark, "transactions", [transaction()]), accounts_frame(spark, "a1")))
    below = text[text.index("hashpartitioning(transaction_id"):]
    assert "_amount" in text and "_amount" not in below
    inputs, root = write_inputs(tmp_path / "in", GOOD), str(tmp_path / "out")
    run_transactions(spark, inputs, root, "r1", MORNING)
    report = tmp_path / "out/snapshots/transactions/fact_transactions.csv"
    assert {f.name.split(".", 1)[1] for f in report.glob("part-*")} == {"csv.gz"}
    assert all(".zstd." in f.name for f in (tmp_path / "out").rglob("version-*/**/part-*.parquet"))
    assert spark.read.csv(str(report), header=True).count() == 40
