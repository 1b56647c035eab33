"""File sources: strict landing scans and tolerant report scans."""

from __future__ import annotations

import warnings
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reliq.schemas import RAW


def utc(at: datetime | None = None) -> datetime:
    """A time with its zone: now where none is given, UTC where it names no zone."""
    if at is None:
        return datetime.now(timezone.utc)
    return at if at.tzinfo else at.replace(tzinfo=timezone.utc)


def arrival(at: datetime | None) -> Column:
    """The time of a load as a column; the clock of the query where none is given."""
    return F.current_timestamp() if at is None else F.lit(utc(at)).cast("timestamp")


#: The column that takes the text of a line that does not fit its table, and the reason it is stored with.
RECORD, DAMAGED_RECORD = "_record", "damaged_record"


def _whole_lines(spark: SparkSession):
    """A reader that takes whole lines apart: with only some columns it would not see that a line does not fit."""
    return spark.read.option("columnPruning", "false")


def _landing(spark: SparkSession, path: str, table: str, mode: str, multi_line: bool) -> DataFrame:
    layout = RAW[table] if mode == "FAILFAST" else T.StructType([*RAW[table].fields, T.StructField(RECORD, T.StringType())])
    return _whole_lines(spark).csv(
        path,
        schema=layout,
        header=True,
        # With a column more than the file, Spark cannot compare the header; ``land_leniently`` does.
        enforceSchema=mode != "FAILFAST",
        escape='"',
        mode=mode,
        columnNameOfCorruptRecord=RECORD,
        multiLine=multi_line,
    )


def land_csv(
    spark: SparkSession, path: str, table: str, at: datetime | None = None, multi_line: bool = False
) -> DataFrame:
    """Landed text columns of a CSV with a header, plus ``ingested_at``.

    A header that does not match raises, as does a line with other than the declared
    columns. Files are split over tasks unless quoted line breaks need ``multi_line``.
    """
    return _landing(spark, path, table, "FAILFAST", multi_line).withColumn("ingested_at", arrival(at))


def land_leniently(
    spark: SparkSession, path: str, table: str, at: datetime | None = None, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Landed text columns as of ``land_csv``, and the lines that do not fit, with their text.

    A line with more or fewer columns than declared is damaged. A header that does not match raises.
    """
    header = header_columns(spark, path).columns
    if header and header != RAW[table].names:
        raise ValueError(f"The header of {path} is {header}, not {RAW[table].names}")
    lines = _landing(spark, path, table, "PERMISSIVE", multi_line)
    good = lines.filter(F.col(RECORD).isNull()).drop(RECORD).withColumn("ingested_at", arrival(at))
    damaged = lines.filter(F.col(RECORD).isNotNull()).select(
        F.lit(table).alias("table_name"),
        F.col(RECORD).alias("record"),
        F.col(RAW[table].names[0]).alias("first_field"),
        F.lit(DAMAGED_RECORD).alias("reject_reason"),
        arrival(at).alias("rejected_at"),
    )
    return good, damaged


def header_columns(spark: SparkSession, path: str) -> DataFrame:
    """A frame with the columns an incoming file declares, as text."""
    return spark.read.csv(path, header=True, escape='"')


#: What Spark says of a file that is absent, empty, or not what it should be.
READ_ERRORS = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "FAILED_READ_FILE", "MALFORMED_RECORD_IN_PARSING", "MALFORMED_CSV_RECORD")


def _condition(error: Exception) -> str:
    return (error.getCondition() or "") if isinstance(error, PySparkException) else ""


def _is_read_error(error: Exception) -> bool:
    """Whether the file is at fault; a lost cluster, a cancelled job or a wrong call is not."""
    if _condition(error).startswith(READ_ERRORS):
        return True
    text = str(error)
    return "java.io.EOFException" in text or "java.util.zip.ZipException" in text or any(name in text for name in READ_ERRORS)


def load_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A report CSV by its own header; empty where it is missing or cannot be read.

    The whole file is read once to look for damage, so that a break behind the first row is
    noticed here: a file that ends in the middle, or a line that does not fit the header.
    """
    try:
        header = header_columns(spark, path).columns
        if not header:
            return spark.createDataFrame([], schema)
        layout = T.StructType([T.StructField(name, T.StringType()) for name in header])
        checked = _whole_lines(spark).csv(
            path,
            schema=T.StructType([*layout.fields, T.StructField(RECORD, T.StringType())]),
            header=True,
            escape='"',
            mode="PERMISSIVE",
            columnNameOfCorruptRecord=RECORD,
        )
        # Another column is read too: Spark refuses to read only the damaged text.
        totals = checked.agg(F.count(RECORD).alias("damaged"), F.count(header[0]).alias("rows")).head()
        if totals["damaged"]:
            warnings.warn(f"Could not read {path}: {totals['damaged']} lines do not fit its header", stacklevel=2)
            return spark.createDataFrame([], schema)
        return spark.read.csv(path, schema=layout, header=True, escape='"', mode="PERMISSIVE")
    except (PySparkException, Py4JJavaError) as error:
        if not _is_read_error(error):
            raise
        if _condition(error) != "PATH_NOT_FOUND":
            warnings.warn(f"Could not read {path}: {error}", stacklevel=2)
        return spark.createDataFrame([], schema)


def load_json(spark: SparkSession, path: str) -> dict:
    """A one-document JSON file as a dict; empty where it is missing or corrupt."""
    try:
        found = spark.read.json(path, multiLine=True, mode="FAILFAST").take(1)
    except (PySparkException, Py4JJavaError) as error:
        if not _is_read_error(error):
            raise
        return {}
    return found[0].asDict(recursive=True) if found else {}
