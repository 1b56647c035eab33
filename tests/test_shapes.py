"""What the plans must look like."""

import re

import pytest
from helpers import accounts_frame, landed, transaction

from reliq.operators import dedupe, metrics, quarantine, reports, staging
from reliq.operators.skew import Hot
from reliq_queries import registry
from reliq_queries.fixtures import Warehouse

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("small"))
    landed(spark, "transactions", [transaction()]).write.parquet(f"{folder}/raw")
    accounts_frame(spark, "a1").write.parquet(f"{folder}/accounts")
    return spark.read.parquet(f"{folder}/raw"), spark.read.parquet(f"{folder}/accounts")


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_classifier_ranks_with_one_exchange(small, no_broadcast):
    text = plan(quarantine.classify_transactions(*small))
    assert len(re.findall(r"Exchange hashpartitioning\(transaction_id", text)) == 1
    assert text.count("Window [") == 1
    assert text.count("SortMergeJoin") == 1


def test_hot_keys_add_an_exchange_of_winners_only(small, no_broadcast):
    hot = {"transaction_id": Hot(("t1",), 2), "account_id": Hot(("a1",), 2)}
    classified = quarantine.classify_transactions(*small, hot=hot)
    classified.collect()
    text = plan(classified)
    final = text[: text.index("Initial Plan")]
    own = r"- Exchange hashpartitioning\(transaction_id#\d+, _lane"
    reused = r"ReusedExchange \[[^\]]*\], Exchange hashpartitioning\(transaction_id#\d+, _lane"
    assert (len(re.findall(own, final)), len(re.findall(reused, final))) == (1, 1)
    assert "_lane" in text and "_piece" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_copies_are_cut_before_the_exchange(small, no_broadcast):
    text = plan(staging.stage_transactions(*small))
    assert re.search(r"WindowGroupLimit.*Partial", text)
    assert "LeftSemi" in text
    large = plan(reports.first_rows(small[0], staging.copy_order("transaction_id"), 20_000))
    assert "TakeOrderedAndProject" in large


def test_orphans_use_an_anti_join(small, no_broadcast):
    assert "LeftAnti" in plan(quarantine.orphan_transactions(*small))


def test_counts_by_reason_read_only_their_keys(small, no_broadcast):
    reads = re.findall(r"ReadSchema: struct<([^>]*)>", plan(quarantine.count_by_reason(*small)))
    assert sorted(reads) == sorted(
        ["amount:string", "account_id:string", "account_id:string", "transaction_id:string"]
    )


def test_daily_metrics_aggregate_before_the_exchange(spark):
    fact = spark.createDataFrame([], "transaction_date date, account_id string, amount decimal(18,2), status string")
    text = plan(metrics.daily_metrics(fact))
    assert re.search(r"Exchange hashpartitioning\(transaction_date#\d+, account_id#\d+", text)
    assert "Expand" not in text


def test_filters_reach_the_scan(small):
    text = plan(dedupe.first_per_key(staging.valid_customers(small[1].withColumnRenamed("customer_country", "full_name")), "customer_id", staging.copy_order()[:0] or [small[1]["account_id"]]))
    assert "IsNotNull(customer_id)" in text


LAZY = [
    "staging_transactions",
    "quarantine_transactions",
    "fact_transactions",
    "daily_transaction_metrics",
    "country_rollup",
    "fact_kpis",
    "schema_drift",
    "run_log_state",
    "institutions_by_state",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_runs_in_the_plans(spark, name):
    text = plan(registry.QUERIES[name](spark, SF))
    assert "Python" not in text and "Pandas" not in text
    assert "CartesianProduct" not in text


def test_hot_keys_of_the_driver_tables_are_none(spark):
    assert Warehouse(spark, SF).hot == {}
