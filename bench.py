"""Time the headline queries: one JSON line on standard output."""

from __future__ import annotations

import json
import os
import sys
import time

from reliq.operators import constraints
from reliq.plans.transactions import run_transactions
from reliq.session import build_session, fresh_dir
from reliq_queries import registry

HEADLINES = [
    "staging_customers",
    "staging_accounts",
    "staging_transactions",
    "quarantine_transactions",
    "quarantine_counts",
    "dim_account",
    "fact_transactions",
    "daily_transaction_metrics",
    "test_summary",
    "reconciliation",
    "schema_drift",
    "run_log_state",
    "fact_kpis",
    "quality_checks",
    "country_rollup",
    "latest_facts",
    "institution_kpis",
    "institutions_by_state",
    "institutions_full_run",
]
WARM_UP = SMALL = "/root/testdata/sf0.001"


def timed(name: str, job) -> float:
    start = time.perf_counter()
    job()
    seconds = round(time.perf_counter() - start, 3)
    print(f"{name}: {seconds}", file=sys.stderr, flush=True)
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        # Written partitions fit eight cores and 60 MB of transactions; a cluster takes 128 MB and more.
        spark__sql__adaptive__advisoryPartitionSizeInBytes="8m",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def query(name: str, folder: str) -> None:
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    # The first run of a plan mostly measures the start of the JVM and its compiler.
    for name in HEADLINES:
        query(name, WARM_UP)
    seconds = {name: timed(name, lambda: query(name, sf_dir)) for name in HEADLINES}

    # The whole run, from landed files to published reports; writing the files is not timed.
    # The second one lands about as many transactions as the published figure is for.
    for name, folder in (("transactions_full_run", sf_dir), ("transactions_small_run", SMALL)):
        inputs = registry.landed_inputs(spark, folder, clean=True)
        root = fresh_dir(spark, "bench")
        seconds[name] = timed(name, lambda: run_transactions(spark, inputs, root, "bench"))
    # The nine tests alone, on stored marts.
    layers = registry.saved_marts(spark, sf_dir)
    marts = [layers.mart(name) for name in ("dim_customer", "dim_account", "fact_transactions")]
    seconds["mart_tests"] = timed("mart_tests", lambda: constraints.mart_results(*marts).collect())
    report = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
