import datetime as dt
from decimal import Decimal

import pytest
from helpers import landed, rows, transaction
from pyspark.sql import functions as F

from reliq.operators import constraints, drift, gates, reconcile
from reliq.schemas import SCHEMA_SNAPSHOTS


def frame(spark, values, ddl):
    return spark.createDataFrame(values, ddl)


def test_unique_ignores_null_and_counts_values(spark):
    df = frame(spark, [("a",), ("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert rows(constraints.unique(df, "k")) == [("a", 3)]
    assert rows(constraints.result("u", constraints.unique(df, "k"))) == [("u", 1, True, True)]


def test_key_results_join_both_tests_of_a_key(spark):
    df = frame(spark, [("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert rows(constraints.key_results(df, "t", "k")) == [("not_null_t_k", 2, True, True), ("unique_t_k", 1, True, True)]
    empty = frame(spark, [], "k string")
    assert rows(constraints.key_results(empty, "t", "k")) == [("not_null_t_k", 0, False, False), ("unique_t_k", 0, False, False)]


def test_not_null(spark):
    df = frame(spark, [("a",), (None,)], "k string")
    assert rows(constraints.result("n", constraints.not_null(df, "k"))) == [("n", 1, True, True)]


def test_accepted_values_counts_distinct_values_and_passes_null(spark):
    df = frame(spark, [("success",), (None,), ("odd",), ("odd",), ("worse",)], "status string")
    assert rows(constraints.accepted_values(df, "status", constraints.STATUSES)) == [("odd", 2), ("worse", 1)]
    results = constraints.scan_results(df, "t", ["status"], {"status": constraints.STATUSES})
    assert rows(results) == [
        ("accepted_values_t_status", 2, True, True),
        ("not_null_t_status", 1, True, True),
    ]
    fine = frame(spark, [("success",), (None,)], "status string")
    assert rows(constraints.scan_results(fine, "t", domains={"status": constraints.STATUSES})) == [
        ("accepted_values_t_status", 0, False, False)
    ]


def test_relationships_ignore_null_children(spark):
    child = frame(spark, [("a",), ("x",), ("x",), (None,)], "k string")
    parent = frame(spark, [("a",), ("b",)], "id string")
    assert rows(constraints.relationships(child, parent, "k", "id")) == [("x",), ("x",)]
    keyed = parent.withColumnRenamed("id", "k")
    assert rows(constraints.orphan_result("r", child, keyed, "k")) == [("r", 2, True, True)]
    assert rows(constraints.orphan_result("r", child.filter("k = 'a'"), keyed, "k")) == [("r", 0, False, False)]


def statuses(spark, raw, fact, quarantined):
    counts = frame(spark, [(raw, fact, quarantined)], "raw_rows long, fact_rows long, quarantined_rows long")
    return {r["check_name"]: (r["check_status"], r["observed_value"]) for r in gates.transaction_gates(counts).collect()}


def test_gates_of_an_empty_load(spark):
    assert statuses(spark, 0, 0, 0) == {
        "fact_table_populated": ("failed", "0"),
        "reject_rate_below_10pct": ("failed", "1.0000"),
        "raw_to_fact_reasonable": ("passed", "0/0"),
    }


def test_gates_at_their_limits(spark):
    assert statuses(spark, 100, 90, 10) == {
        "fact_table_populated": ("passed", "90"),
        "reject_rate_below_10pct": ("failed", "0.1000"),
        "raw_to_fact_reasonable": ("passed", "90/100"),
    }
    assert statuses(spark, 10000, 9706, 300)["reject_rate_below_10pct"] == ("passed", "0.0300")
    assert statuses(spark, 100, 89, 9)["raw_to_fact_reasonable"][0] == "failed"


def test_institution_gates(spark):
    def found(valid, rejected):
        counts = frame(spark, [(valid, rejected)], "valid_rows long, rejected_rows long")
        return [r["check_status"] for r in gates.institution_gates(counts).collect()]

    assert found(4201, 3) == ["passed", "passed"]
    assert found(99, 0) == ["failed", "passed"]
    assert found(0, 0) == ["failed", "passed"]
    assert found(100, 50) == ["passed", "failed"]


def test_failed_checks_are_named(spark):
    counts = frame(spark, [(100, 0, 50)], "raw_rows long, fact_rows long, quarantined_rows long")
    checks = gates.transaction_gates(counts)
    audited = gates.audit_rows(checks, "r1", F.current_timestamp())
    assert audited.filter("dag_run_id = 'r1'").count() == 3
    with pytest.raises(gates.GateFailure, match="fact_table_populated.*reject_rate_below_10pct.*raw_to_fact"):
        gates.require_passed(checks)


@pytest.mark.parametrize(
    ("source", "target", "status", "variance"),
    [
        (100, 96, "ok", "4.000000"),
        (100, 95, "warning", "5.000000"),
        (100, 91, "warning", "9.000000"),
        (100, 90, "failed", "10.000000"),
        (100, 110, "failed", "-10.000000"),
        (0, 5, "ok", "0.000000"),
        (3, 2, "failed", "33.333333"),
    ],
)
def test_reconciliation_limits(spark, source, target, status, variance):
    pairs = frame(spark, [(Decimal(source), Decimal(target))], "source_value decimal(20,4), target_value decimal(20,4)")
    got = reconcile.with_variance(pairs).head()
    assert (got["status"], got["variance_pct"]) == (status, Decimal(variance))


def test_reconcile_totals(spark):
    raw = landed(
        spark,
        "transactions",
        [transaction(amount="10"), transaction(id="t2", amount="-3"), transaction(id="t3", amount="2.5", status="failed")],
    )
    fact = frame(spark, [(Decimal("10.00"), "success")], "amount decimal(18,2), status string")
    got = {r["metric_name"]: (r["source_value"], r["target_value"], r["status"]) for r in reconcile.reconcile_totals(raw, fact).collect()}
    assert got == {
        "transaction_count": (3, 1, "failed"),
        "transaction_value": (Decimal("12.5"), 10, "failed"),
        "successful_count": (2, 1, "failed"),
    }
    with pytest.raises(gates.GateFailure, match="transaction_count"):
        reconcile.require_reconciled(reconcile.reconcile_totals(raw, fact))


def history(spark, *captures):
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    made = [(run, "t", names.split(), start + dt.timedelta(minutes=i), None) for i, (run, names) in enumerate(captures)]
    return spark.createDataFrame(made, SCHEMA_SNAPSHOTS)


@pytest.mark.parametrize(
    ("captures", "added", "removed", "first_run"),
    [
        ([("r1", "a b")], [], [], True),
        ([("r1", "a b"), ("r2", "a b")], [], [], False),
        ([("r1", "a b"), ("r2", "a b d c")], ["c", "d"], [], False),
        ([("r1", "a b"), ("r2", "a")], [], ["b"], False),
        ([("r1", "a b"), ("r2", "a c")], ["c"], ["b"], False),
        ([("r1", "a b"), ("r2", "b a")], [], [], False),
        ([("r1", "a b"), ("r2", "a"), ("r2", "a")], [], ["b"], False),
        ([("r1", "a"), ("r2", "a b"), ("r3", "a b")], [], [], False),
    ],
)
def test_drift(spark, captures, added, removed, first_run):
    got = drift.detect_drift(history(spark, *captures)).head()
    assert (got["added"], got["removed"], got["first_run"]) == (added, removed, first_run)
    assert got["drift"] == bool(added or removed)


def test_drift_is_raised_with_its_columns(spark):
    found = drift.detect_drift(history(spark, ("r1", "a b"), ("r2", "a c")))
    with pytest.raises(gates.GateFailure, match=r"t: added=\['c'\] removed=\['b'\]"):
        drift.require_no_drift(found)
    assert rows(drift.second_newest(history(spark, ("r1", "a b"), ("r2", "a c"))), "dag_run_id") == [("r1",)]


def test_the_tests_of_the_marts_read_each_table_once(spark, tmp_path):
    names = {"customers": "customer_id string", "accounts": "account_id string", "fact": "transaction_id string, account_id string, amount decimal(18,2), status string"}
    made = {
        "customers": [("c1",), ("c1",), (None,)],
        "accounts": [("a1",), (None,), (None,), ("a2",), ("a2",)],
        "fact": [("t1", "a1", Decimal(1), "success"), ("t1", "x", None, "odd"), (None, None, None, None), ("t2", "x", Decimal(1), "odd"), ("t3", "a2", Decimal(1), "odder")],
    }
    for name, values in made.items():
        frame(spark, values, names[name]).write.parquet(str(tmp_path / name))
    got = constraints.mart_results(*[spark.read.parquet(str(tmp_path / name)) for name in names])
    assert {r["test_name"]: r["failures"] for r in got.collect()} == {
        "unique_dim_customer_customer_id": 1,
        "not_null_dim_customer_customer_id": 1,
        "unique_dim_account_account_id": 1,
        "not_null_dim_account_account_id": 2,
        "unique_fact_transactions_transaction_id": 1,
        "not_null_fact_transactions_transaction_id": 1,
        "not_null_fact_transactions_amount": 2,
        "accepted_values_fact_transactions_status": 2,
        "relationships_fact_transactions_account_id": 2,
    }
    text = got._sc._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")
    text = text[: text.index("Initial Plan")] if "Initial Plan" in text else text
    assert text.count("FileScan parquet") == 3 and text.count("Exchange hashpartitioning") == 1 and "Join" not in text
    assert all(r["failures"] == 0 for r in constraints.mart_results(*[spark.createDataFrame([], ddl) for ddl in names.values()]).collect())


def test_schema_snapshot_and_types(spark):
    df = frame(spark, [(1, "x")], "b long, a string")
    assert drift.schema_snapshot(df, "r1", "t")[:3] == ("r1", "t", ["b", "a"])
    assert drift.schema_snapshot(df, "r1", "t")[4] == ["bigint", "string"]


def typed(spark, *captures):
    """Snapshots of a table ``t``: (run, {column: type}) in order of time; no types where they are None."""
    made = [
        (run, "t", list(columns), dt.datetime(2024, 1, 1 + i, tzinfo=dt.timezone.utc), None if None in columns.values() else list(columns.values()))
        for i, (run, columns) in enumerate(captures)
    ]
    return spark.createDataFrame(made, SCHEMA_SNAPSHOTS)


def test_a_changed_type_is_drift(spark):
    kept = typed(spark, ("r1", {"a": "int", "b": "string"}), ("r2", {"b": "string", "a": "bigint", "c": "date"}))
    assert rows(drift.type_drift(kept)) == [("t", "r2", "a", "int", "bigint")]
    with pytest.raises(gates.GateFailure, match=r"t: added=\['c'\] removed=\[\]; t: a was int, is bigint"):
        drift.require_no_drift(drift.detect_drift(kept), drift.type_drift(kept))
    moved = typed(spark, ("r1", {"a": "int", "b": "string"}), ("r2", {"b": "string", "a": "int"}), ("r2", {"b": "string", "a": "int"}))
    assert rows(drift.type_drift(moved)) == []
    untyped = typed(spark, ("r1", {"a": None}), ("r2", {"a": "int"}))
    assert rows(drift.type_drift(untyped)) == []
