"""Exact dedup by a stream with kept state."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from samples import ODD

from reliq.llm import exact


def plain(text):
    return re.sub("[ \t-\r]+", " ", text or "")


def brute(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[plain(row[1])].append(row[0])
    want = []
    for text, ids in groups.items():
        first = min((i is None, i or 0) for i in ids)
        keep = None if first[0] else first[1]
        stays = True
        for i in sorted(ids, key=lambda i: (i is None, i or 0)):
            want.append((i, keep, len(ids), stays, hashlib.sha256(text.encode()).hexdigest()))
            stays = False
    return sorted(want, key=str)


@pytest.fixture
def filed(spark, tmp_path, make):
    """Documents written to some files and read again."""

    def build(rows, files=3, name="documents"):
        path = str(tmp_path / name)
        make(rows).repartition(files).write.parquet(path)
        return spark.read.parquet(path)

    return build


def judged(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


ROWS = [
    *ODD, (900, "a  copy\nof this"), (20, "a copy of this"), (31, " a copy of this"), (32, "a copy of this"), (32, "a copy of this"),
    (None, "a copy\tof this"), (None, "nobody's"), (None, "nobody's"), (40, None), (41, ""), (42, " "), (43, "\n"), (44, "x" * 300_000), (45, "x" * 300_000),
    (46, "no-break space"), (47, "no-break space"), *[(100 + i, "hot") for i in range(80)],
]


def test_groups_equal_plain_python(filed):
    assert judged(exact.outcome(filed(ROWS))) == brute([row[:2] for row in ROWS])


def test_equal_digests_of_different_bytes_are_told_apart(filed):
    rows = ROWS + [(2000 + i, f"text {i % 300}") for i in range(900)]
    got = exact.outcome(filed(rows), key=lambda text: F.pmod(F.length(text), F.lit(7)).cast("string").cast("binary"))
    assert judged(got) == brute([row[:2] for row in rows])


def test_no_documents(filed):
    assert exact.outcome(filed([], 1)).collect() == []


def test_columns_with_names_of_the_operator(spark, tmp_path, make):
    rows = [(1, "one"), (2, "one"), (3, "two")]
    names = "file place digest sha256 first n unnamed".split()
    make(rows).selectExpr("*", *[f"'x' as {name}" for name in names]).write.parquet(str(tmp_path / "clash"))
    assert judged(exact.outcome(spark.read.parquet(str(tmp_path / "clash")))) == brute(rows)


def test_state_goes_on_where_it_stopped(spark, tmp_path, filed, monkeypatch):
    monkeypatch.setattr(exact, "BATCH_BYTES", 1)
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "state")
    first, second = [(i, f"text {i % 10}") for i in range(50, 90)], [(i, f"text {i % 12}") for i in range(24)]
    exact.append_log(filed(first, 4, "first"), log)
    state = exact.absorb(spark, log, checkpoint)
    assert sorted((r["first"]["doc_id"], r["n"]) for r in state.collect()) == [(50 + i, 4) for i in range(10)]
    exact.append_log(filed(second, 2, "second"), log)
    state = exact.absorb(spark, log, checkpoint)
    assert sorted((r["first"]["doc_id"], r["n"]) for r in state.collect()) == [(i, 6 if i < 10 else 2) for i in range(12)]
    # One file was read by each micro-batch: the state was carried on through all of them.
    import os

    assert len([name for name in os.listdir(f"{checkpoint}/commits") if not name.startswith(".")]) >= 6
