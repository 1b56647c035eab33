"""Tables that take in only new keys.

A table is bucketed by its key. Incoming rows are dealt to the buckets and anti-joined with what is
stored there; the stored side, which grows, is read in place and never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reliq.operators.dedupe import insert_ignore
from reliq.sinks.tables import observed


class KeyedTable:
    """A stored table with one row per key, as a bucketed table of the catalog."""

    def __init__(self, spark: SparkSession, name: str, path: str, key: str, buckets: int):
        self.spark, self.name, self.path, self.key, self.buckets = spark, name, path, key, buckets

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def missing(self, incoming: DataFrame, order: Sequence[Column]) -> DataFrame:
        """The incoming rows whose key is not stored, one row per key.

        Planned with at most as many shuffle partitions as there are buckets, the join reads the buckets
        as they are; with more, Spark deals both sides anew.
        """
        return insert_ignore(self.read(), incoming, self.key, order)

    def insert_new(self, incoming: DataFrame, order: Sequence[Column]) -> int:
        """Append the first row of each key that is not stored, and return how many there were.

        An insert that ends in between has stored nothing; run again, it brings the same rows.
        """
        if not self.exists():
            self._write(incoming.limit(0))
        before = self.spark.conf.get("spark.sql.shuffle.partitions")
        self.spark.conf.set("spark.sql.shuffle.partitions", str(min(int(before), self.buckets)))
        try:
            new, seen = observed(self.missing(incoming, order), {"rows": F.count(F.lit(1))})
            self._write(new)
        finally:
            self.spark.conf.set("spark.sql.shuffle.partitions", before)
        return seen()["rows"] or 0

    def _write(self, df: DataFrame) -> None:
        writer = df.write.mode("append").bucketBy(self.buckets, self.key).sortBy(self.key)
        writer.option("path", self.path).saveAsTable(self.name)
