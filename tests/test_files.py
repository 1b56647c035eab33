import datetime as dt
import gzip
import json
import os

import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reliq.schemas import INSTITUTION, RAW_CUSTOMERS
from reliq.session import fresh_dir, shared_dir
from reliq.sinks.snapshots import publish_institutions, write_csv
from reliq.sinks.tables import publish_view, save_mart
from reliq.sources.files import header_columns, land_csv, land_leniently, load_csv, load_json
from reliq.sources.layers import table_columns
from reliq.operators.gates import GateFailure
from reliq.sinks.logs import append_log, compact_day, log_days, log_files, read_log, read_newest
from reliq.sinks.versions import write_version
from reliq.sources.pages import fetch_institutions, page_documents, page_gaps, page_sizes, read_pages, read_records, require_complete, source_page

CUSTOMERS = 'customer_id,full_name,email,country,signup_date\nc1,"Doe, ""J""",j@x,EE,2024-01-01\nc2,,,LV,2024-01-02\n'


def test_landing_keeps_text_and_adds_the_arrival(spark, tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text(CUSTOMERS)
    got = land_csv(spark, str(path), "customers")
    assert rows(got.drop("ingested_at")) == [
        ("c1", 'Doe, "J"', "j@x", "EE", "2024-01-01"),
        ("c2", None, None, "LV", "2024-01-02"),
    ]
    assert table_columns(got) == [*RAW_CUSTOMERS.names, "ingested_at"]


def test_landing_refuses_another_header(spark, tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text(CUSTOMERS.replace("full_name", "name"))
    with pytest.raises(Exception, match="CSV header does not conform"):
        land_csv(spark, str(path), "customers").collect()
    assert header_columns(spark, str(path)).columns[1] == "name"


def test_landing_refuses_a_line_of_another_width(spark, tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text(CUSTOMERS + "c3,x\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST"):
        land_csv(spark, str(path), "customers").collect()


def test_a_lenient_landing_keeps_damaged_lines_with_their_text(spark, tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text(CUSTOMERS + "c3,x\nc4,a,b,c,d,e\n\nc5,e,f,g,h\n")
    good, damaged = land_leniently(spark, str(path), "customers")
    assert [r[0] for r in rows(good, "customer_id")] == ["c1", "c2", "c5"]
    assert good.columns == [*RAW_CUSTOMERS.names, "ingested_at"]
    assert rows(damaged, "table_name", "record", "first_field", "reject_reason") == [
        ("customers", "c3,x", "c3", "damaged_record"),
        ("customers", "c4,a,b,c,d,e", "c4", "damaged_record"),
    ]
    path.write_text(CUSTOMERS.replace("full_name", "name"))
    with pytest.raises(ValueError, match="header"):
        land_leniently(spark, str(path), "customers")


def test_landing_of_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text(CUSTOMERS.replace("j@x", '"j\nx"'))
    assert ("c1", "j\nx") in rows(land_csv(spark, str(path), "customers", multi_line=True), "customer_id", "email")


def test_tolerant_reads(spark, tmp_path):
    path = tmp_path / "report.csv"
    path.write_text("b,customer_id\n1,c1\n")
    assert rows(load_csv(spark, str(path), RAW_CUSTOMERS)) == [("1", "c1")]
    assert load_csv(spark, str(tmp_path / "absent.csv"), RAW_CUSTOMERS).columns == RAW_CUSTOMERS.names
    good, bad = tmp_path / "good.json", tmp_path / "bad.json"
    good.write_text(json.dumps({"generated_at": "now", "institution_count": 3}, indent=2))
    bad.write_text("{not json")
    assert load_json(spark, str(good)) == {"generated_at": "now", "institution_count": 3}
    assert load_json(spark, str(bad)) == {}
    assert load_json(spark, str(tmp_path / "absent.json")) == {}
    for name, content in (("wide", "a,b\n1,2\n3,4,5\n"), ("short", "a,b\n1,2\n3\n")):
        (tmp_path / f"{name}.csv").write_text(content)
        with pytest.warns(UserWarning, match="1 lines do not fit"):
            assert rows(load_csv(spark, str(tmp_path / f"{name}.csv"), RAW_CUSTOMERS)) == []
    (tmp_path / "empty.csv").write_text("")
    assert load_csv(spark, str(tmp_path / "empty.csv"), RAW_CUSTOMERS).columns == RAW_CUSTOMERS.names
    cut = tmp_path / "cut.csv.gz"
    cut.write_bytes(gzip.compress(("b,customer_id\n" + "".join(f"{i},c{i * 7919}\n" for i in range(9000))).encode())[:20_000])
    with pytest.warns(UserWarning, match="Could not read"):
        assert rows(load_csv(spark, str(cut), RAW_CUSTOMERS)) == []
    torn = tmp_path / "torn.csv.gz"
    torn.write_bytes(b"no gzip at all")
    with pytest.warns(UserWarning, match="Could not read"):
        assert load_csv(spark, str(torn), RAW_CUSTOMERS).columns == RAW_CUSTOMERS.names


def test_csv_round_trip(spark, tmp_path):
    made = [("c1", ' lead "q", x ', "", "EE", None)]
    df = spark.createDataFrame(made, RAW_CUSTOMERS)
    write_csv(df, str(tmp_path / "out"))
    assert rows(land_csv(spark, str(tmp_path / "out"), "customers").drop("ingested_at")) == [
        ("c1", ' lead "q", x ', None, "EE", None)
    ]


def page(*made):
    return {"data": [{"data": m, "score": 1} for m in made], "meta": {"total": len(made)}}


def test_pages_are_unwrapped_filtered_and_ordered(spark, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    first = page(
        dict(CERT=1, NAME="a", ASSET=5, ACTIVE=1, EXTRA="x"),
        dict(CERT=2, NAME="b", ASSET=7.5, ACTIVE=0),
    )
    (folder / "page0.json").write_text(json.dumps(first, indent=2))
    (folder / "page1.json").write_text(
        json.dumps(page(dict(CERT=3, NAME="c", ASSET=9, ACTIVE=1), dict(CERT=4, NAME="d", ACTIVE=1)), indent=2)
    )
    (folder / "page2.json").write_text(json.dumps(page(), indent=2))
    assert read_pages(spark, str(folder)).count() == 4
    got = fetch_institutions(spark, str(folder))
    assert got.columns == INSTITUTION.names
    assert sorted(r["CERT"] for r in got.collect()) == [1, 3, 4]
    assert [r["CERT"] for r in source_page(read_pages(spark, str(folder)), 1, offset=1).collect()] == [1]


def test_all_pages_are_kept(spark, tmp_path):
    pages = spark.range(0, 12_500).groupBy(F.floor(F.col("id") / 1000).alias("p")).agg(
        F.collect_list(F.struct(F.struct(F.col("id").alias("CERT"), F.lit(1).alias("ACTIVE")).alias("data"))).alias("data")
    )
    pages.select("data").write.json(str(tmp_path / "pages"))
    assert fetch_institutions(spark, str(tmp_path / "pages"), multi_line=False).count() == 12_500


def test_institution_files(spark, tmp_path):
    records = spark.createDataFrame([(1, "a")], "CERT long, NAME string")
    records = records.select(*[F.col(n) if n in ("CERT", "NAME") else F.lit(None).cast(INSTITUTION[n].dataType).alias(n) for n in INSTITUTION.names])
    counts = spark.createDataFrame([(1, 0)], "valid_rows long, rejected_rows long")
    assert publish_institutions(records, counts, str(tmp_path), "2024-01-01T00:00:00+00:00") == {"institutions.csv": 1}
    assert load_json(spark, f"{tmp_path}/meta.json") == {
        "generated_at": "2024-01-01T00:00:00+00:00",
        "institution_count": 1,
        "rejected_count": 0,
    }
    records.write.json(str(tmp_path / "records"))
    assert rows(read_records(spark, str(tmp_path / "records")), "CERT", "NAME") == [(1, "a")]


def test_models_as_view_and_table(spark, tmp_path):
    df = spark.range(3)
    publish_view(df, "some_model")
    assert spark.table("some_model").count() == 3
    spark.sql(f"create database if not exists marts_test location '{tmp_path}/marts'")
    for _ in range(2):
        save_mart(df, "marts_test.some_mart")
    assert spark.table("marts_test.some_mart").count() == 3


def test_work_folders_are_below_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == named.rstrip("/")
    assert fresh_dir(spark, "x").startswith(named) and fresh_dir(spark, "x") != fresh_dir(spark, "x")


def test_gaps_between_pages_are_found(spark):
    def gaps(*pages):
        return rows(page_gaps(spark.createDataFrame(list(pages), "offset long, rows int, total long")))

    assert gaps((0, 10, 25), (10, 10, 25), (20, 5, 25)) == []
    assert gaps((0, 10, 25), (20, 5, 25)) == [(10, 10)]
    assert gaps((0, 10, 25), (10, 7, 25), (20, 5, 25)) == [(17, 3)]
    assert gaps((10, 10, 25)) == [(0, 10), (20, 5)]
    assert gaps((0, 0, 0)) == [] and rows(page_gaps(spark.createDataFrame([], "offset long, rows int, total long"))) == []


def test_a_page_left_out_is_refused(spark, tmp_path):
    made = [page(dict(CERT=i, NAME="a", ACTIVE=1), dict(CERT=i + 1, NAME="b", ACTIVE=1)) for i in range(0, 8, 2)]
    for i, document in enumerate(made):
        document["meta"] = {"total": 8, "offset": 2 * i}
        (tmp_path / f"page{i}.json").write_text(json.dumps(document))
    require_complete(page_sizes(page_documents(spark, str(tmp_path))))
    os.remove(tmp_path / "page1.json")
    with pytest.raises(GateFailure, match="2 from offset 2 on"):
        require_complete(page_sizes(page_documents(spark, str(tmp_path))))


LOG = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.LongType())])


def test_many_appends_become_one_file(spark, tmp_path):
    path, day = str(tmp_path / "log"), dt.date(2024, 6, 1)
    many = spark.range(0, 1000, 1, 1000).selectExpr("concat('r', id) as name", "id as n", "uuid() as entry")
    many.write.parquet(f"{path}/run_day={day}")
    append_log(spark.createDataFrame([("last", 1)], LOG), path, LOG, day)
    assert len(log_files(spark, path, day)) == 1001
    assert compact_day(spark, path, LOG, day) and not compact_day(spark, path, LOG, day)
    assert len(log_files(spark, path, day)) == 1
    assert tuple(read_log(spark, path, LOG).agg(F.sum("n"), F.count("name")).head()) == (499501, 1001)


def test_a_compaction_that_ends_early_counts_no_row_twice(spark, tmp_path, monkeypatch):
    path, day = str(tmp_path / "log"), dt.date(2024, 6, 1)
    for i in range(3):
        append_log(spark.createDataFrame([("r", i)], LOG), path, LOG, day)
    from reliq.sinks import logs

    def lost(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(logs, "files_of", lost)
    with pytest.raises(RuntimeError, match="driver lost"):
        compact_day(spark, path, LOG, day, most=1)
    assert len(log_files(spark, path, day)) == 4
    assert rows(read_log(spark, path, LOG)) == [("r", 0), ("r", 1), ("r", 2)]
    monkeypatch.undo()
    assert compact_day(spark, path, LOG, day, most=1)
    assert len(log_files(spark, path, day)) == 1 and read_log(spark, path, LOG).count() == 3


def test_only_the_days_needed_are_read(spark, tmp_path):
    path = str(tmp_path / "log")
    assert read_log(spark, path, LOG).count() == 0 and log_days(spark, path) == []
    for i in range(9):
        append_log(spark.createDataFrame([(f"r{i}", i)], LOG), path, LOG, dt.date(2024, 5, 28) + dt.timedelta(days=i))
    got = read_newest(spark, path, LOG, lambda found: found.count() >= 2)
    assert rows(got, "n") == [(7,), (8,)]
    text = got._sc._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")
    assert "PartitionFilters: [run_day#" in text and "2024-06-05" in text
    assert read_newest(spark, path, LOG, lambda found: found.count() >= 3).count() == 4
    assert read_newest(spark, path, LOG, lambda found: False).count() == 9


def test_a_table_without_marks_of_success_is_refused(spark, tmp_path):
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        with pytest.raises(RuntimeError, match="_SUCCESS"):
            write_version(spark.range(3), str(tmp_path / "table"))
    finally:
        hadoop.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
