"""Institution records from landed pages of nested JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reliq.operators.gates import GateFailure
from reliq.operators.topk import first_rows
from reliq.schemas import INSTITUTION, INSTITUTION_PAGE

# Fixed value: the paging of the source.
PAGE_SIZE = 1_000
#: Gaps that an error names at most.
MOST_GAPS = 20


def page_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The landed pages: one document per file, or one per line."""
    return spark.read.schema(INSTITUTION_PAGE).json(path, multiLine=multi_line, mode="FAILFAST")


def read_pages(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per record of all pages."""
    return page_documents(spark, path, multi_line).select(F.explode("data").alias("r")).select("r.data.*")


def page_sizes(pages: DataFrame) -> DataFrame:
    """``offset``, ``rows`` and ``total`` of each page that states its offset; pages landed twice count once."""
    sizes = pages.select(F.col("meta.offset").alias("offset"), F.size("data").alias("rows"), F.col("meta.total").alias("total"))
    return sizes.filter("offset is not null").groupBy("offset").agg(F.max("rows").alias("rows"), F.max("total").alias("total"))


def page_gaps(sizes: DataFrame) -> DataFrame:
    """Records that no page holds: ``offset`` where they start, and ``missing``, how many there are.

    A page ends where the next one starts, and the last where the source ends. Each page is compared
    with the end of the one before it; there is one row per page, so one task ranks them.
    """
    last = sizes.agg(F.max("total").alias("offset"), F.lit(0).alias("rows"), F.max("total").alias("total"))
    known = sizes.unionByName(last.filter("offset is not null"))
    reached = F.lag(F.col("offset") + F.col("rows"), 1, 0).over(Window.orderBy("offset", F.desc("rows")))
    gaps = known.withColumn("reached", reached).filter("offset > reached")
    return gaps.select(F.col("reached").cast("bigint").alias("offset"), (F.col("offset") - F.col("reached")).cast("bigint").alias("missing"))


def require_complete(sizes: DataFrame) -> None:
    """Raise with the offsets at which landed pages leave records out."""
    found = page_gaps(sizes).orderBy("offset").head(MOST_GAPS)
    if found:
        gaps = ", ".join(f"{row['missing']} from offset {row['offset']} on" for row in found)
        raise GateFailure(f"Landed pages lack records of the source: {gaps}")


def source_page(records: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    """Active institutions by assets, largest first, as the source pages them."""
    active = records.filter("ACTIVE = 1")
    order = [F.desc_nulls_last("ASSET"), F.asc("CERT")]
    top = first_rows(active, order, offset + limit)
    return top.offset(offset) if offset else top


def fetch_institutions(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The active records of all landed pages."""
    return read_pages(spark, path, multi_line).filter("ACTIVE = 1")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Institution records stored one per line."""
    return spark.read.schema(INSTITUTION).json(path, mode="FAILFAST")
