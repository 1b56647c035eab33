"""Run registered queries beside their SQL: ``python tests/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
            pages benchmark labels conversations""".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, (int, float, Decimal, str, bool, type(None), datetime.date)):
        return value
    return str(value)


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(cell(row[i]) for i in order) for row in rows)


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(df, con, sql: str) -> list[str]:
    """What differs between a Spark result and a SQL result, types included."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    kinds = dict(zip(names, [str(d[1]).upper() for d in found.description]))
    expected = rows_of(names, found.fetchall())
    actual = rows_of(df.columns, [tuple(row) for row in df.collect()])
    issues = []
    if sorted(names) != sorted(df.columns):
        issues.append(f"columns {sorted(df.columns)} against {sorted(names)}")
    for name, kind in df.dtypes:
        wanted = kinds.get(name, "")
        spark_kind = KINDS.get(kind, kind.upper())
        if spark_kind.replace(" ", "") != wanted.replace(" ", "") and wanted not in ("NUMBER", "STRING", "DATETIME"):
            issues.append(f"type of {name}: {kind} against {wanted}")
    if expected != actual:
        extra, missing = actual - expected, expected - actual
        issues.append(
            f"rows {sum(actual.values())} against {sum(expected.values())}; "
            f"only here {list(extra.items())[:2]}, only in SQL {list(missing.items())[:2]}"
        )
    return issues


def main(sf_dir: str, only: list[str]) -> int:
    import __spark_entry__ as contract
    from reliq.session import build_session

    spark = build_session("local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    sql = contract.oracle_sql()
    for name, query in contract.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            issues = differences(df, con, sql[name]) if name in sql else [f"no SQL, {df.count()} rows"]
        except Exception as error:
            issues = [f"{type(error).__name__}: {str(error)[:900]}"]
        failed += bool(issues)
        print(f"{'FAIL' if issues else 'ok  '} {name} {time.time() - start:.2f}s {'; '.join(issues)}", flush=True)
    print("without a query:", sorted(set(sql) - set(contract.queries())))
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
