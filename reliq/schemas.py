"""Column layouts of every layer."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
DATE = T.DateType()
TIMESTAMP = T.TimestampType()
COUNT = T.LongType()
MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(5, 4)
# Wide enough to compare an amount before it is rounded to cents.
EXACT = T.DecimalType(38, 18)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def _text(*names: str) -> T.StructType:
    return _struct(**{name: TEXT for name in names})


# The columns of the landed tables, in order.
RAW_CUSTOMERS = _text("customer_id", "full_name", "email", "country", "signup_date")
RAW_ACCOUNTS = _text("account_id", "customer_id", "account_type", "currency", "opened_date")
RAW_TRANSACTIONS = _text(
    "transaction_id", "account_id", "transaction_date", "amount", "currency", "status", "merchant"
)
RAW = {"customers": RAW_CUSTOMERS, "accounts": RAW_ACCOUNTS, "transactions": RAW_TRANSACTIONS}


def _with(layout: T.StructType, **columns: T.DataType) -> T.StructType:
    return T.StructType([*layout.fields, *_struct(**columns).fields])


# The columns of the staged tables, the star schema and the audit tables, in order.
STG_CUSTOMERS = _struct(customer_id=TEXT, full_name=TEXT, email=TEXT, country=TEXT, signup_date=DATE)
STG_ACCOUNTS = _struct(account_id=TEXT, customer_id=TEXT, account_type=TEXT, currency=TEXT, opened_date=DATE)

DIM_CUSTOMER = _with(STG_CUSTOMERS, signup_year=T.IntegerType())
DIM_ACCOUNT = _struct(
    account_id=TEXT,
    customer_id=TEXT,
    customer_name=TEXT,
    customer_country=TEXT,
    account_type=TEXT,
    currency=TEXT,
    opened_date=DATE,
)
DIM_DATE = _struct(
    date_day=DATE,
    year=T.IntegerType(),
    month=T.IntegerType(),
    day=T.IntegerType(),
    day_of_week=T.IntegerType(),
    day_name=TEXT,
    month_name=TEXT,
    quarter=T.IntegerType(),
)
FACT_TRANSACTIONS = _struct(
    transaction_id=TEXT,
    account_id=TEXT,
    customer_id=TEXT,
    customer_country=TEXT,
    account_type=TEXT,
    transaction_date=DATE,
    transaction_day=DATE,
    transaction_hour=T.IntegerType(),
    amount=MONEY,
    currency=TEXT,
    status=TEXT,
    merchant=TEXT,
)
#: The month of a fact's date, by which facts are stored.
FACT_MONTH = "transaction_month"
# Landed transactions once per outcome, with the account context of the facts.
CLASSIFIED = _with(
    RAW_TRANSACTIONS,
    customer_id=TEXT,
    customer_country=TEXT,
    account_type=TEXT,
    outcome=TEXT,
    recorded_at=TIMESTAMP,
)

DAILY_METRICS = _struct(
    metric_date=DATE,
    total_transactions=COUNT,
    total_value=MONEY,
    successful_count=COUNT,
    failed_count=COUNT,
    success_rate=RATE,
    avg_transaction=MONEY,
    active_accounts=COUNT,
    updated_at=TIMESTAMP,
)

RUN_EVENTS = _struct(
    dag_run_id=TEXT,
    dag_id=TEXT,
    event=TEXT,
    event_ts=TIMESTAMP,
    status=TEXT,
    records_extracted=COUNT,
    records_loaded=COUNT,
    records_quarantined=COUNT,
    error_message=TEXT,
)

QUALITY_CHECKS = _struct(
    dag_run_id=TEXT,
    check_name=TEXT,
    check_status=TEXT,
    observed_value=TEXT,
    expected_value=TEXT,
    message=TEXT,
    checked_at=TIMESTAMP,
)

RECONCILIATION = _struct(
    dag_run_id=TEXT,
    metric_name=TEXT,
    source_value=T.DecimalType(20, 4),
    target_value=T.DecimalType(20, 4),
    difference=T.DecimalType(20, 4),
    variance_pct=T.DecimalType(10, 6),
    status=TEXT,
    checked_at=TIMESTAMP,
)

SCHEMA_SNAPSHOTS = _struct(
    dag_run_id=TEXT,
    table_name=TEXT,
    column_names=T.ArrayType(TEXT),
    captured_at=TIMESTAMP,
    column_types=T.ArrayType(TEXT),
)

# Landed lines that do not fit their table, as text.
DAMAGED = _struct(table_name=TEXT, record=TEXT, first_field=TEXT, reject_reason=TEXT, rejected_at=TIMESTAMP)

# The institution fields, in their published order.
INSTITUTION = _struct(
    CERT=COUNT,
    NAME=TEXT,
    CITY=TEXT,
    STALP=TEXT,
    STNUM=COUNT,
    ASSET=T.DoubleType(),
    DEP=T.DoubleType(),
    NETINC=T.DoubleType(),
    ROA=T.DoubleType(),
    ROE=T.DoubleType(),
    ACTIVE=COUNT,
    BKCLASS=TEXT,
    SPECGRP=COUNT,
    REPDTE=TEXT,
)

INSTITUTION_PAGE = T.StructType(
    [
        T.StructField("data", T.ArrayType(T.StructType([T.StructField("data", INSTITUTION)]))),
        T.StructField("meta", T.StructType([T.StructField("total", COUNT), T.StructField("offset", COUNT)])),
    ]
)

INSTITUTION_META = _struct(generated_at=TEXT, institution_count=COUNT, rejected_count=COUNT)

JUDGED_INSTITUTION = _with(INSTITUTION, _reason=TEXT)

# Layer tables, by layer and name.
LAYERS = {
    "raw": {
        **{name: _with(layout, ingested_at=TIMESTAMP) for name, layout in RAW.items()},
        "institutions": INSTITUTION,
    },
    "staging": {
        "customers": _with(STG_CUSTOMERS, ingested_at=TIMESTAMP),
        "accounts": _with(STG_ACCOUNTS, ingested_at=TIMESTAMP),
        "institutions": JUDGED_INSTITUTION,
    },
    "classified": {"transactions": CLASSIFIED, **{f"damaged_{name}": DAMAGED for name in RAW}},
    "analytics": {
        "dim_customer": DIM_CUSTOMER,
        "dim_account": DIM_ACCOUNT,
        "dim_date": DIM_DATE,
        "fact_transactions": FACT_TRANSACTIONS,
    },
    "ops": {
        "run_events": RUN_EVENTS,
        "quality_checks": QUALITY_CHECKS,
        "reconciliation": RECONCILIATION,
        "schema_snapshots": SCHEMA_SNAPSHOTS,
    },
}
