"""The landed tables, derived from the driver tables.

The driver tables hold no defects, so they are derived here by fixed rules. The same
rules are written as SQL in the module ``oracle``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reliq.functions.together import together
from reliq.operators import marts, quarantine, staging
from reliq.operators.skew import NONE, Hot, HotKeys, hot_keys
from reliq.schemas import INSTITUTION, RAW_TRANSACTIONS
from reliq.session import configure


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its file schema is looked up once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def raw_customers(spark: SparkSession, sf_dir: str, clean: bool = False) -> DataFrame:
    """Customers; those without a positive balance lack a name, unless ``clean``."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    key = F.col("c_custkey")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, "c_nationkey")
        .select(
            key.cast("string").alias("customer_id"),
            F.when(F.lit(clean) | (F.col("c_acctbal") > 0), F.col("c_name")).alias("full_name"),
            F.concat(F.lit("c"), key.cast("string"), F.lit("@example.com")).alias("email"),
            F.col("n_name").alias("country"),
            F.date_sub(F.lit("2024-01-01").cast("date"), (key % 730).cast("int")).cast("string").alias("signup_date"),
            F.lit("2024-01-01").cast("timestamp").alias("ingested_at"),
        )
    )


def raw_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("account_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderpriority").alias("account_type"),
        F.when(status == "O", "EUR").when(status == "F", "USD").otherwise("GBP").alias("currency"),
        F.col("o_orderdate").cast("date").cast("string").alias("opened_date"),
        F.col("o_orderdate").cast("timestamp").alias("ingested_at"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str, clean: bool = False) -> DataFrame:
    """Transactions with derived defects, or with almost none when ``clean``."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("merchant"))
    # Joined first: the driver's columns are narrower than the texts derived from them.
    lines = table(spark, sf_dir, "lineitem").join(part, "l_partkey")
    return transaction_lines(lines, clean, "merchant").select(*RAW_TRANSACTIONS.names, "ingested_at")


def transaction_lines(lineitem: DataFrame, clean: bool = False, *carry: str) -> DataFrame:
    """Transactions that lack their merchant, unless it is among the columns to ``carry``."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    order, quantity = F.col("l_orderkey").cast("string"), F.col("l_quantity")
    transaction_id = F.concat_ws("-", order, F.col("l_linenumber").cast("string"))
    hours = F.expr("make_dt_interval(0, cast(l_partkey % 24 as int))")
    account, amount = order, price
    if clean:
        transaction_id = F.concat_ws("-", transaction_id, F.col("l_partkey").cast("string"))
    else:
        account = F.when(F.col("l_suppkey") % 97 == 0, "A999999").otherwise(order)
        refunded = (F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.095)
        amount = F.when(refunded, -price).otherwise(price)
    return (
        lineitem.select(
            transaction_id.alias("transaction_id"),
            account.alias("account_id"),
            F.date_format(F.col("l_shipdate").cast("timestamp") + hours, "yyyy-MM-dd HH:mm:ss").alias(
                "transaction_date"
            ),
            amount.cast("string").alias("amount"),
            F.when(F.col("l_linestatus") == "O", "EUR").otherwise("USD").alias("currency"),
            F.when(quantity >= 48, "failed").when(quantity <= 1, "pending").otherwise("success").alias("status"),
            F.col("l_shipdate").cast("timestamp").alias("ingested_at"),
            *carry,
        )
    )


def institutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    key = F.col("c_custkey")
    given = {
        "CERT": key,
        "NAME": F.col("c_name"),
        "CITY": F.concat(F.lit("City "), F.col("c_nationkey").cast("string")),
        "STALP": F.col("n_name"),
        "STNUM": F.col("c_nationkey"),
        "ASSET": F.col("c_acctbal"),
        "DEP": F.col("c_acctbal") * 0.5,
        "NETINC": F.col("c_acctbal") * 0.25,
        "ROA": key % 100 / 8,
        "ROE": key % 64 / 4,
        "ACTIVE": F.lit(1),
        "BKCLASS": F.col("c_mktsegment"),
        "SPECGRP": key % 9,
        "REPDTE": F.concat(F.lit("2024-0"), (1 + key % 4).cast("string"), F.lit("-30")),
    }
    rows = table(spark, sf_dir, "customer").join(nation, "c_nationkey")
    return rows.select(*[given[f.name].cast(f.dataType).alias(f.name) for f in INSTITUTION])


def institution_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page documents of at most 1,000 records: ids are unique, a page is a range of them.

    Every tenth institution also has an inactive record, under its negative id. A page states its
    offset and how many records there are in all.
    """
    record = F.struct(F.struct(*INSTITUTION.names).alias("data"))
    active = institutions(spark, sf_dir)
    closed = active.filter("CERT % 10 = 0").withColumns({"CERT": -F.col("CERT"), "ACTIVE": F.lit(0).cast(INSTITUTION["ACTIVE"].dataType)})
    pages = active.unionByName(closed).groupBy(F.floor(F.col("CERT") / 1000).alias("page"))
    filled = pages.agg(F.collect_list(record["data"]).alias("records"), F.count("*").alias("n"))
    # One row per page.
    before = F.sum("n").over(Window.orderBy("page").rowsBetween(Window.unboundedPreceding, -1))
    every = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return filled.select(
        F.transform("records", lambda r: F.struct(r.alias("data"))).alias("data"),
        F.struct(every.alias("total"), F.coalesce(before, F.lit(0)).alias("offset")).alias("meta"),
    )


def torn_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sizes of pages of ten customers each: every seventh page is lost, every third lacks those in debt."""
    page = F.floor(F.col("c_custkey") / 10)
    kept = (page % 7 != 3) & ((page % 3 != 0) | (F.col("c_acctbal") > 0))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    total = customers.agg((F.max("c_custkey") + 1).cast("bigint").alias("total"))
    pages = customers.filter(kept).groupBy((page * 10).cast("bigint").alias("offset")).agg(F.count("*").alias("rows"))
    return pages.join(F.broadcast(total))


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as lines of a CSV: those of one brand lack their last fields, those of another have one more."""
    rows = raw_transactions(spark, sf_dir).select(*RAW_TRANSACTIONS.names)
    line, merchant = F.concat_ws(",", *RAW_TRANSACTIONS.names), F.col("merchant")
    cut = F.concat_ws(",", *RAW_TRANSACTIONS.names[:4])
    return rows.select(
        F.when(merchant.like("%1"), cut).when(merchant.like("%2"), F.concat(line, F.lit(",more"))).otherwise(line).alias("value")
    )


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as a run: it starts with the order and finishes once it has line items.

    Every tenth run is finished twice, the second time with success.
    """
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("extracted"),
        F.count_if(F.col("l_returnflag") == "R").alias("quarantined"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    runs = orders.join(lines, "o_orderkey", "left")
    key, start = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    failed = F.col("o_orderstatus") == "F"

    def at(milliseconds):
        return F.timestamp_millis(F.unix_millis(start) + milliseconds)

    def event(name, when, status, counted, error):
        def count(column):
            return (column if counted else F.lit(0)).cast("bigint")

        return F.struct(
            F.lit(name).alias("event"),
            when.alias("event_ts"),
            status.alias("status"),
            count(F.col("extracted")).alias("records_extracted"),
            count(F.col("extracted") - F.col("quarantined")).alias("records_loaded"),
            count(F.col("quarantined")).alias("records_quarantined"),
            error.cast("string").alias("error_message"),
        )

    done = F.col("extracted").isNotNull()
    elapsed = F.col("extracted") * 1370 + key % 1000
    no_error = F.lit(None)
    outcome = F.when(failed, "failed").otherwise("success")
    events = F.array_compact(
        F.array(
            event("started", start, F.lit("running"), False, no_error),
            F.when(done, event("finished", at(elapsed), outcome, True, F.when(failed, F.lit("order closed")))),
            F.when(
                done & (key % 10 == 0), event("finished", at(elapsed + 5000), F.lit("success"), True, no_error)
            ),
        )
    )
    return runs.select(
        key.cast("string").alias("dag_run_id"),
        F.when(key % 2 == 0, "transactions_daily").otherwise("institutions_daily").alias("dag_id"),
        F.explode(events).alias("e"),
    ).select("dag_run_id", "dag_id", "e.*")


def schema_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer as a table and each order as a run that captures its columns and their types.

    Every fifth run is retried a minute later, with one more column. Types follow the order: totals
    are text in every fourth, ids in every sixth.
    """
    key = F.col("o_orderkey")
    names = F.array_compact(
        F.array(
            F.lit("order_id"),
            F.when(F.col("o_orderstatus") == "F", "closed_at"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "urgent"),
            F.lit("total"),
        )
    )
    tries = F.when(key % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    captured = table(spark, sf_dir, "orders").select("*", F.explode(tries).alias("attempt"))
    start = F.col("o_orderdate").cast("timestamp")
    every = F.when(F.col("attempt") == 1, F.array_append(names, F.lit("retried"))).otherwise(names)

    def kind(name):
        as_text = ((name == "total") & (key % 4 == 0)) | ((name == "order_id") & (key % 6 == 0))
        return F.when(as_text, "string").when(name == "total", "decimal(18,2)").otherwise("bigint")

    return captured.select(
        key.cast("string").alias("dag_run_id"),
        F.concat(F.lit("table_"), F.col("o_custkey").cast("string")).alias("table_name"),
        every.alias("column_names"),
        F.timestamp_seconds(F.unix_seconds(start) + F.col("attempt") * 60).alias("captured_at"),
        F.transform(every, kind).alias("column_types"),
    )


@dataclass
class Warehouse:
    """Lazy frames of every layer over one set of driver tables."""

    spark: SparkSession
    sf_dir: str
    clean: bool = False

    def __post_init__(self):
        configure(self.spark)

    def raw(self, name: str) -> DataFrame:
        if name == "transactions":
            return raw_transactions(self.spark, self.sf_dir, self.clean)
        if name == "customers":
            return raw_customers(self.spark, self.sf_dir, self.clean)
        return raw_accounts(self.spark, self.sf_dir)

    @cached_property
    def hot(self) -> HotKeys:
        """Hot keys of the landed tables, from samples of their key columns."""
        lines = transaction_lines(table(self.spark, self.sf_dir, "lineitem"), self.clean)
        transactions, accounts = together(
            partial(hot_keys, lines, "transaction_id", "account_id"),
            partial(hot_keys, self.raw("accounts"), "customer_id"),
        )
        return {**transactions, **accounts}

    def hot_values(self, column: str) -> Hot:
        return self.hot.get(column, NONE)

    def customers(self) -> DataFrame:
        return staging.stage_customers(self.raw("customers"))

    def accounts(self) -> DataFrame:
        return staging.stage_accounts(self.raw("accounts"), self.customers(), hot=self.hot_values("customer_id"))

    def transactions(self) -> DataFrame:
        return staging.stage_transactions(
            self.raw("transactions"), self.accounts(), hot=self.hot_values("account_id")
        )

    def dim_customer(self) -> DataFrame:
        return marts.dim_customer(staging.stg_customers(self.customers()))

    def dim_account(self) -> DataFrame:
        return marts.dim_account_of_landed(
            self.raw("accounts"), staging.stg_customers(self.customers()), hot=self.hot_values("customer_id")
        )

    def fact(self) -> DataFrame:
        return marts.fact_of_landed(
            self.raw("transactions"), self.dim_account(), hot=self.hot_values("account_id")
        )

    def quarantine(self) -> DataFrame:
        return quarantine.quarantine_transactions(self.raw("transactions"), self.accounts(), hot=self.hot)
