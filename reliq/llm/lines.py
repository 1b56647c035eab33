"""Line dedup over levelled sorted runs of line hashes.

Documents come in batches. The digest of a batch (one row per line key, with the number of
documents and the largest document id) is merge-anti-joined with the runs stored so far: keys that
no run holds enter a new run of level 0, so that every key lies in one run; keys that a run holds
are stored as updates of that run. Once a level holds ``FANOUT`` runs they are compacted: their
updates are added to their rows, and the rows, which have no key in common, become one run of the
next level. Runs are bucketed and sorted by the key, so the joins need no shuffle of the stored side.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reliq.llm.text import WHITE, ascii_lower, key128, small_side, stored, whole_text
from reliq.session import fresh_dir

MIN_CODE_POINTS = 20
MIN_DOCUMENTS = 3
BATCHES = 4
FANOUT = 2
#: Rows of repeated keys up to which they are broadcast to the documents (24 bytes each).
BROADCAST_KEYS = 1_000_000
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


class Runs:
    """The sorted runs of one corpus, by level, as bucketed tables in the shared folder."""

    def __init__(self, spark: SparkSession, buckets: int | None = None):
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.root = fresh_dir(spark, "line-runs")
        self.name = f"line_runs_{uuid.uuid4().hex}"
        self.levels: dict[int, list[int]] = defaultdict(list)
        #: Per run the tables that hold updates of its rows.
        self.updates: dict[int, list[int]] = defaultdict(list)
        self.written = 0

    def table(self, number: int) -> str:
        return f"{self.name}_{number}"

    def write(self, df: DataFrame) -> int:
        number, self.written = self.written, self.written + 1
        dealt = df.repartition(self.buckets, *KEY).write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
        dealt.option("path", f"{self.root}/{number}").saveAsTable(self.table(number))
        return number

    def runs(self) -> list[int]:
        return [run for level in sorted(self.levels) for run in self.levels[level]]

    def held(self, run: int) -> DataFrame:
        return self.spark.table(self.table(run)).select(*KEY)

    def add(self, digest: DataFrame) -> None:
        """Merge-anti-join a batch with every run: what is left is a run, the rest updates."""
        new, repeats = digest, []
        for run in self.runs():
            repeats.append(digest.join(self.held(run), KEY, "left_semi").withColumn("run", F.lit(run)))
            new = new.join(self.held(run), KEY, "left_anti")
        if repeats:
            updates = self.write(reduce(DataFrame.unionByName, repeats))
            for run in self.runs():
                self.updates[run].append(updates)
        self.levels[0].append(self.write(new))
        self.compact()

    def compact(self) -> None:
        level = 0
        while len(self.levels[level]) >= FANOUT:
            merged = self.write(self.rows(self.levels[level]))
            self.levels[level + 1].append(merged)
            self.levels[level] = []
            level += 1

    def totals(self) -> DataFrame:
        """Every key once, with its documents and the largest document id."""
        return self.rows(self.runs())

    def rows(self, runs: list[int]) -> DataFrame:
        """The rows of some runs with their updates; runs share no key."""
        return reduce(DataFrame.unionByName, [self.updated(run) for run in runs])

    def updated(self, run: int) -> DataFrame:
        first = self.spark.table(self.table(run)).select(*KEY, "docs", "top")
        if not self.updates[run]:
            return first
        # Read as plain files: a union of bucketed scans counts as dealt by the key, but is not always read so.
        schema = self.spark.table(self.table(self.updates[run][0])).schema
        files = [f"{self.root}/{number}" for number in self.updates[run]]
        later = self.spark.read.schema(schema).parquet(*files).filter(F.col("run") == run)
        later = later.groupBy(*KEY).agg(F.sum("docs").alias("more"), F.max("top").alias("later"))
        docs = F.col("docs") + F.coalesce("more", F.lit(0))
        return first.join(later, KEY, "left").select(*KEY, docs.alias("docs"), F.greatest("top", "later").alias("top"))

    def drop(self) -> None:
        """Take the tables out of the catalog."""
        for number in range(self.written):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.table(number)}")


def line_digest(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Per batch and line key: rows of ``docs`` that hold it and their largest id.

    A row counts once however often it repeats a line.
    """
    keys = F.array_distinct(F.transform(F.split(whole_text(docs), "\n"), line_key))
    long_keys = F.filter(keys, lambda key: F.length(key) >= MIN_CODE_POINTS)
    lines = docs.select(
        F.pmod(F.xxhash64(docs["doc_id"]), F.lit(batches)).cast("int").alias("batch"),
        docs["doc_id"].alias("top"),
        F.explode(long_keys).alias("key"),
    )
    h1, h2 = key128(F.col("key"))
    hashed = lines.select("batch", "top", h1.alias("h1"), h2.alias("h2"))
    return hashed.groupBy("batch", *KEY).agg(F.count("*").alias("docs"), F.max("top").alias("top"))


def repeated_keys(docs: DataFrame, runs: Runs, batches: int = BATCHES) -> DataFrame:
    """Line keys of at least ``MIN_DOCUMENTS`` documents and the largest id that holds each.

    ``runs`` may already hold earlier batches of the same corpus.
    """
    digest = line_digest(docs, batches)
    path = fresh_dir(docs.sparkSession, "line-digest")
    digest.write.partitionBy("batch").parquet(path)
    read = docs.sparkSession.read.schema(digest.schema).parquet(path)
    for batch in range(batches):
        runs.add(read.filter(F.col("batch") == batch).drop("batch"))
    return runs.totals().filter(F.col("docs") >= MIN_DOCUMENTS).select(*KEY, "top")


def drop_repeated_lines(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Rows ``row`` (the columns of ``docs``), ``n_lines``, ``n_dropped`` and ``kept``, the rest of the text.

    The text is split at line feeds; null or empty text is one empty line. A line's key is the
    line without white space around it, A-Z lower-cased. A key of at least ``MIN_CODE_POINTS``
    code points in at least ``MIN_DOCUMENTS`` rows loses all its lines but those in the row of
    the largest doc_id (in each row, if several share that id; a null id is below all others).
    """
    runs = Runs(docs.sparkSession)
    try:
        hot = small_side(stored(repeated_keys(docs, runs, batches), "line-keys"), BROADCAST_KEYS)
    finally:
        runs.drop()
    text = whole_text(docs)
    whole = docs.select(
        F.struct(*[docs[name] for name in docs.columns]).alias("row"),
        docs["doc_id"].alias("id"),
        F.xxhash64(text).alias("hash"),
        text.alias("text"),
    )
    lines = whole.select("id", "hash", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    h1, h2 = key128(line_key(F.col("line")))
    keyed = lines.filter(F.length("line") >= MIN_CODE_POINTS).select(
        "id", "hash", "place", h1.alias("h1"), h2.alias("h2")
    )
    doomed = keyed.join(hot, KEY).filter(~F.col("id").eqNullSafe(F.col("top")))
    # Equal rows have equal lines, so their places are collected once.
    dropped = doomed.groupBy("id", "hash").agg(F.collect_set("place").alias("places"))
    dropped = dropped.select(F.col("id").alias("id_"), F.col("hash").alias("hash_"), "places")
    same = F.col("id").eqNullSafe(F.col("id_")) & (F.col("hash") == F.col("hash_"))
    split = whole.join(dropped, same, "left").select("row", "text", "places", F.split("text", "\n").alias("lines"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("places"))
    rest = F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")
    return split.select(
        "row",
        F.size("lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("places"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("places").isNull(), F.col("text")).otherwise(rest).alias("kept"),
    )
