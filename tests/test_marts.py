import datetime as dt
import random
import statistics
from decimal import Decimal

from helpers import landed, rows, transaction
from pyspark.sql import functions as F

from reliq.operators import institutions, marts, metrics, reports, runlog, staging
from reliq.operators.quantiles import exact_median
from reliq.operators.topk import first_rows, newest_days
from reliq.schemas import INSTITUTION
from reliq.schemas import FACT_MONTH
from reliq.sinks.upsert import MOST_SETS, last_upsert, stored_days, upsert_daily_metrics
from reliq.sinks.versions import complete_versions
from reliq.sinks.versions import current_path, write_version

FIXED = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def small_star(spark):
    customers = landed(spark, "customers", [("c1", "Ann", "a@x", "EE", "2023-03-04"), ("c2", "Bob", "b@x", "LV", "2022-01-01")])
    accounts = landed(
        spark,
        "accounts",
        [("a1", "c1", "checking", "EUR", "2024-01-02"), ("a2", "c2", "savings", "USD", "2024-01-03"), ("a2", "c1", "late", "USD", "2024-01-03", 5)],
    )
    transactions = landed(
        spark,
        "transactions",
        [
            transaction("t1", "a1", "2024-05-01 23:30:00", "10.005"),
            transaction("t2", "a2", "2024-05-01 01:00:00", "5", status="failed"),
            transaction("t3", "a1", "2024-05-02 00:00:00", "2", status="pending"),
            transaction("t4", "a1", "2024-05-02 00:00:00", "0.004"),
        ],
    )
    return customers, accounts, transactions


def test_facts_by_way_of_staging_equal_facts_of_landed_rows(spark):
    customers, accounts, transactions = small_star(spark)
    staged_customers = staging.stg_customers(staging.stage_customers(customers))
    staged_accounts = staging.stage_accounts(accounts, staged_customers)
    dim = marts.dim_account(staging.stg_accounts(staged_accounts), staged_customers)
    direct_dim = marts.dim_account_of_landed(accounts, staged_customers)
    assert rows(dim) == rows(direct_dim)
    assert ("a2", "c2", "Bob", "LV", "savings", "USD", dt.date(2024, 1, 3)) in rows(dim)
    staged = staging.stage_transactions(transactions, staged_accounts)
    fact = marts.fact_transactions(staging.stg_transactions(staged), dim)
    assert rows(fact) == rows(marts.fact_of_landed(transactions, direct_dim))
    first = fact.filter("transaction_id = 't1'").head()
    assert (first["transaction_date"], first["transaction_hour"], first["amount"], first["customer_country"]) == (
        dt.date(2024, 5, 1),
        23,
        Decimal("10.01"),
        "EE",
    )
    assert fact.count() == 3
    assert fact.columns == marts.FACT_COLUMNS


def test_dim_date_covers_four_years(spark):
    days = marts.dim_date(spark)
    assert days.count() == 1461
    assert rows(days.filter("date_day = '2024-02-29'")) == [
        (dt.date(2024, 2, 29), 2024, 2, 29, 4, "Thursday ", "February ", 1)
    ]


def test_dim_customer(spark):
    customers = staging.stg_customers(staging.stage_customers(small_star(spark)[0]))
    assert rows(marts.dim_customer(customers), "customer_id", "signup_year") == [("c1", 2023), ("c2", 2022)]


def small_fact(spark):
    customers, accounts, transactions = small_star(spark)
    return marts.fact_of_landed(
        transactions, marts.dim_account_of_landed(accounts, staging.stage_customers(customers))
    )


def test_daily_metrics(spark):
    assert rows(metrics.daily_metrics(small_fact(spark))) == [
        (dt.date(2024, 5, 1), 2, Decimal("15.01"), 1, 1, Decimal("0.5000"), Decimal("7.51"), 2),
        (dt.date(2024, 5, 2), 1, Decimal("2.00"), 0, 0, Decimal("0.0000"), Decimal("2.00"), 1),
    ]


def test_upsert_keeps_old_days_and_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "daily")
    daily = metrics.daily_metrics(small_fact(spark))
    assert upsert_daily_metrics(spark, daily, path, FIXED) == 2
    changed = daily.filter("metric_date = '2024-05-02'").withColumn("active_accounts", F.lit(9))
    other_year = changed.withColumn("metric_date", F.lit("2025-01-01").cast("date"))
    for _ in range(2):
        assert upsert_daily_metrics(spark, changed.unionByName(other_year), path, FIXED) == 2
    assert rows(stored_days(spark, path), "metric_date", "active_accounts") == [
        (dt.date(2024, 5, 1), 2),
        (dt.date(2024, 5, 2), 9),
        (dt.date(2025, 1, 1), 9),
    ]
    assert upsert_daily_metrics(spark, daily.limit(0), path, FIXED) == 0
    assert stored_days(spark, path).count() == 3


def test_an_upsert_of_one_day_writes_one_day(spark, tmp_path):
    path = tmp_path / "daily"

    def files():
        return {str(f): (f.stat().st_mtime_ns, f.read_bytes()) for f in path.rglob("part-*.parquet")}

    daily = metrics.daily_metrics(small_fact(spark))
    upsert_daily_metrics(spark, daily, str(path), FIXED)
    before = files()
    one = daily.filter("metric_date = '2024-05-02'").withColumn("active_accounts", F.lit(9))
    assert upsert_daily_metrics(spark, one, str(path), FIXED) == 1
    after = files()
    assert {name: after[name] for name in before} == before
    new = sorted(set(after) - set(before))
    assert rows(spark.read.parquet(*new), "metric_date", "active_accounts") == [(dt.date(2024, 5, 2), 9)]
    assert rows(last_upsert(spark, str(path)), "metric_date") == [(dt.date(2024, 5, 2),)]


def test_many_upserts_are_merged_without_a_change(spark, tmp_path):
    path = str(tmp_path / "daily")
    daily = metrics.daily_metrics(small_fact(spark))
    for i in range(MOST_SETS + 2):
        day = F.date_add(F.lit("2025-01-01").cast("date"), i // 2)
        upsert_daily_metrics(spark, daily.limit(1).withColumns({"metric_date": day, "active_accounts": F.lit(i)}), path, FIXED)
    assert len(complete_versions(spark, path)) <= MOST_SETS
    assert rows(stored_days(spark, path), "active_accounts") == [(i,) for i in range(1, MOST_SETS + 2, 2)]


def test_the_newest_facts_are_read_from_their_months(spark, tmp_path):
    made = [(f"t{i:03}", dt.date(2024, 1 + i % 6, 1 + i % 28) if i % 50 else None, Decimal(i)) for i in range(300)]
    names = [n for n in reports.SNAPSHOT_COLUMNS if n not in ("transaction_id", "transaction_date", "amount")]
    fact = spark.createDataFrame(made, "transaction_id string, transaction_date date, amount decimal(18,2)")
    fact = marts.with_month(fact.withColumns({n: F.lit("x") for n in names}))
    fact.write.partitionBy(FACT_MONTH).parquet(str(tmp_path / "fact"))
    stored = spark.read.parquet(str(tmp_path / "fact"))
    days = stored.groupBy(F.col("transaction_date").alias("metric_date")).agg(F.count("*").alias("total_transactions"))
    for n in (1, 20, 294, 299, 1000):
        got = reports.latest_dated_facts(stored, days, n)
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in reports.latest_facts(stored, n).collect()]
    text = got._sc._jvm.PythonSQLUtils.explainString(reports.latest_dated_facts(stored, days, 20)._jdf.queryExecution(), "simple")
    assert f"PartitionFilters: [isnotnull({FACT_MONTH}" in text and "2024-06-01" in text
    assert "PushedFilters: [IsNotNull(transaction_date), GreaterThanOrEqual(transaction_date" in text
    assert text.count("FileScan") == 1


def test_an_interrupted_upsert_loses_nothing(spark, tmp_path):
    path = tmp_path / "daily"
    daily = metrics.daily_metrics(small_fact(spark))
    upsert_daily_metrics(spark, daily, str(path), FIXED)
    # A version that was begun, but not finished, is not the table.
    half = path / "version-000000000002"
    half.mkdir()
    (half / "part-0.parquet").write_text("torn")
    assert stored_days(spark, str(path)).count() == 2
    later = daily.limit(1).withColumn("metric_date", F.lit("2025-01-01").cast("date"))
    assert upsert_daily_metrics(spark, later, str(path), FIXED) == 1
    assert stored_days(spark, str(path)).count() == 3


def test_a_reader_of_a_reloaded_table_sees_a_whole_version(spark, tmp_path):
    path = str(tmp_path / "t")
    assert current_path(spark, path) is None
    write_version(spark.range(3), path)
    reader = spark.read.parquet(current_path(spark, path))
    write_version(spark.range(5), path)
    assert (reader.count(), spark.read.parquet(current_path(spark, path)).count()) == (3, 5)
    for _ in range(3):
        write_version(spark.read.parquet(current_path(spark, path)), path)
    assert len(list((tmp_path / "t").iterdir())) == 2


def test_reports(spark):
    fact = small_fact(spark)
    breakdown = spark.createDataFrame([("negative_amount", 2), ("orphan_account", 3)], "reject_reason string, count long")
    assert rows(reports.fact_kpis(fact, breakdown)) == [(3, Decimal("17.01"), 2, 1, 5)]
    assert [tuple(r) for r in reports.status_counts(fact.withColumn("status", F.nullif("status", F.lit("failed")))).collect()] == [
        ("pending", 1),
        ("success", 1),
    ]
    customers = spark.createDataFrame([("c1", "EE")], "customer_id string, country string")
    assert [tuple(r) for r in reports.country_rollup(fact, customers).collect()] == [
        ("EE", 2, Decimal("12.01")),
        (None, 1, Decimal("5.00")),
    ]
    assert rows(reports.layer_row_counts(fact, fact, fact, breakdown)) == [(3, 3, 3, 5)]
    daily = metrics.daily_metrics(fact)
    assert reports.latest_metrics(daily, 1).head()["metric_date"] == dt.date(2024, 5, 2)
    assert [r[0] for r in reports.value_trend(daily).collect()] == [dt.date(2024, 5, 1), dt.date(2024, 5, 2)]
    latest = reports.latest_facts(fact)
    assert [r["transaction_id"] for r in latest.collect()] == ["t3", "t1", "t2"]
    assert latest.columns == reports.SNAPSHOT_COLUMNS


def test_large_top_k_equals_a_sorted_limit(spark):
    df = spark.range(0, 9000, numPartitions=6).select((F.col("id") * 7919 % 9001).alias("n"), "id")
    order = [F.desc("n"), F.asc("id")]
    assert [tuple(r) for r in first_rows(df, order, 3000).collect()] == [
        tuple(r) for r in df.orderBy(*order).limit(3000).collect()
    ]


def test_exact_median(spark):
    rng = random.Random(3)
    samples = [
        [rng.random() for _ in range(500)],
        [float(rng.randrange(5)) for _ in range(501)],
        [1.0] * 250 + [2.0] * 250,
        [5.0] * 400 + [rng.random() for _ in range(100)],
        [3.0],
    ]
    for values in samples:
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
        assert exact_median(df, "v").collect() == [(statistics.median(values),)]
    assert exact_median(spark.createDataFrame([], "v double"), "v").collect() == [(None,)]


def test_newest_days_hold_enough_rows(spark):
    made = [(dt.date(2024, 1, 1 + i % 7) if i % 11 else None, i) for i in range(200)]
    df = spark.createDataFrame(made, "day date, id int")
    order = [F.desc("day"), F.asc("id")]
    for n in (0, 1, 30, 181, 182, 183, 199, 200, 500):
        kept = newest_days(df, "day", n)
        assert kept.count() <= n + 40
        assert [tuple(r) for r in first_rows(kept, order, n).collect()] == [tuple(r) for r in df.orderBy(*order).limit(n).collect()]


def records(spark, *made):
    names = INSTITUTION.names
    return spark.createDataFrame([tuple(m.get(n) for n in names) for m in made], INSTITUTION)


def test_the_first_broken_rule_rejects_an_institution(spark):
    made = records(
        spark,
        dict(CERT=0, NAME="zero", ASSET=5.0),
        dict(CERT=1, NAME="", ASSET=5.0),
        dict(CERT=2, NAME=None, ASSET=5.0),
        dict(CERT=3, NAME="null assets"),
        dict(CERT=4, NAME="no assets", ASSET=0.0),
        dict(CERT=None, NAME="both", ASSET=-1.0),
        dict(CERT=6, NAME="fine", ASSET=0.5),
    )
    judged = institutions.with_reason(made)
    assert rows(judged, "NAME", "_reason") == sorted(
        [
            ("zero", institutions.MISSING),
            ("", institutions.MISSING),
            (None, institutions.MISSING),
            ("null assets", institutions.NON_POSITIVE),
            ("no assets", institutions.NON_POSITIVE),
            ("both", institutions.MISSING),
            ("fine", None),
        ],
        key=repr,
    )
    assert rows(institutions.valid_records(judged), "CERT") == [(6,)]
    assert rows(institutions.outcome_counts(judged)) == [(1, 6)]
    assert rows(institutions.reason_counts(judged)) == [(institutions.MISSING, 4), (institutions.NON_POSITIVE, 2)]


def test_institution_reports(spark):
    made = records(
        spark,
        dict(CERT=1, NAME="a", STALP="NY", ASSET=3_000_000.0),
        dict(CERT=2, NAME="b", STALP="NY", ASSET=1_005_000.0),
        dict(CERT=3, NAME="c", STALP="", ASSET=3_000_000.0),
        dict(CERT=4, NAME="d", STALP=None, ASSET=None),
    )
    assert rows(institutions.summarise(made, FIXED)) == [(4, 1, Decimal("7.00"), FIXED.isoformat())]
    assert rows(institutions.kpis(made)) == [(4, 2, Decimal("7.005"), Decimal("3"))]
    assert [r["CERT"] for r in institutions.top_by_assets(made, 20).collect()] == [1, 3, 2]
    assert rows(institutions.by_state(made), "STALP", "banks", "assets_b") == [
        ("", 1, Decimal("3")),
        ("NY", 2, Decimal("4.005")),
    ]
    assert institutions.display(made.select("ASSET", "NAME", "STALP")).columns == ["NAME", "STALP", "ASSET"]


def test_run_state_takes_the_latest_finish(spark):
    start = FIXED
    events = runlog.event(spark, ("r1", "d"), start).unionByName(runlog.event(spark, ("r2", "d"), start))
    for seconds, status, error in ((5, "failed", "boom"), (9, "success", None)):
        ended = start + dt.timedelta(seconds=seconds)
        finish = runlog.event(spark, ("r1", "d"), ended, status, runlog.Counts(10, 8, 2), error)
        events = events.unionByName(finish)
    state = runlog.run_state(events)
    assert rows(state, "dag_run_id", "status", "records_loaded", "duration_seconds", "error_message") == [
        ("r1", "success", 8, Decimal("9.00"), None),
        ("r2", "running", 0, None, None),
    ]
    assert [r["dag_run_id"] for r in runlog.recent_runs(state, 1).collect()] == ["r1"]
