"""Exact dedup by a stream with keyed state: the first row of every text, kept for good.

Fingerprints of documents (digest, stable identifier, content locator) are appended to a log. A
stream reads the log and keeps, per digest, the smallest identifier with its locator and the
number of rows; its state lies in RocksDB, is checkpointed to the shared folder and never expires,
so a later batch of documents meets everything before it. Digests that were hit more than once are
checked against the full bytes of the row that the locator names.

Everything is built-in column functions. Copies of a text meet as a count per task before they
are shuffled, so a group of any size weighs one row per task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reliq.llm.text import stored, whole_text
from reliq.session import fresh_dir

#: Log that one micro-batch reads for each state partition.
BATCH_BYTES = 4 << 20
#: Bytes of digests and locators of repeated texts up to which they are broadcast.
BROADCAST_BYTES = 32 << 20
# Where state is kept, and how much memory it may use there.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Many small stores: space is not taken before it is used.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
PLACE = ["file", "place"]


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space."""
    return F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def located(docs: DataFrame) -> DataFrame:
    """Documents read from files, as ``doc_id``, ``text`` (normalised), ``file`` and ``place`` in it."""
    found = docs.metadataColumn("_metadata")
    return docs.select(
        docs["doc_id"].alias("doc_id"),
        normalised(whole_text(docs)).alias("text"),
        found["file_path"].alias("file"),
        found["row_index"].alias("place"),
    )


def append_log(docs: DataFrame, log: str, key: Callable[[Column], Column] = sha256) -> None:
    """Append the fingerprints of documents to a log."""
    rows = located(docs).withColumns({"sha256": sha256(F.col("text")), "digest": key(F.col("text"))})
    rows.select("doc_id", "digest", *PLACE, "sha256").write.mode("append").parquet(log)


def absorb(spark: SparkSession, log: str, checkpoint: str) -> DataFrame:
    """Bring the state up to the end of the log and return it: ``digest``, ``first`` and ``n``.

    May be called again when the log has grown: the stream goes on where it stopped.
    """
    before = {name: spark.conf.get(name, None) for name in STATE_SETTINGS}
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        source = spark.readStream.schema(spark.read.parquet(log).schema).option("maxBytesPerTrigger", parts * BATCH_BYTES)
        first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", *PLACE))
        state = source.parquet(log).groupBy("digest").agg(first.alias("first"), F.count("*").alias("n"))
        writer = state.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
        kept = spark.read.format("statestore").load(checkpoint)
        # The state's fields are named by their functions; their order is that of the aggregates.
        return stored(kept.select("key.digest", "value.*").toDF("digest", "first", "n"), "state")
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def strangers(docs: DataFrame, state: DataFrame, key: Callable[[Column], Column] = sha256) -> DataFrame:
    """Texts that share the digest of a row whose bytes differ: ``digest`` and ``text``, stored.

    Rows of a digest with more than one row are grouped by their whole text, so equal bytes meet
    in every task before the shuffle; a text is known if the row at the locator is among its rows.
    """
    hits = state.filter("n > 1").select("digest", F.col("first.file").alias("first_file"), F.col("first.place").alias("first_place"))
    hits = stored(hits, "hits")
    size = hits.agg(F.sum(F.octet_length("digest") + F.octet_length("first_file") + 8)).head()[0] or 0
    read = located(docs).withColumn("digest", key(F.col("text")))
    met = read.join(F.broadcast(hits) if size <= BROADCAST_BYTES else hits, "digest")
    is_first = (F.col("file") == F.col("first_file")) & (F.col("place") == F.col("first_place"))
    texts = met.groupBy("digest", "text").agg(F.max(is_first.cast("int")).alias("known"))
    return stored(texts.filter("known = 0").drop("known"), "strangers")


def outcome(docs: DataFrame, key: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document: ``doc_id``, ``file``, ``place``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``docs`` is read from Parquet files. Null text counts as empty, and as equal to it. Of equal texts the
    row with the smallest doc_id stays; rows of one id go by file and place, so of repeated rows
    exactly one stays. A null doc_id is above all others. ``key`` is the digest that the state is
    kept by: rows whose bytes differ are told apart whatever it is.
    """
    spark = docs.sparkSession
    log, checkpoint = fresh_dir(spark, "dedup-log"), fresh_dir(spark, "dedup-state")
    append_log(docs, log, key)
    state = absorb(spark, log, checkpoint)
    rows = spark.read.parquet(log)
    apart = strangers(docs, state, key)
    if apart.isEmpty():
        judged = rows.join(state, "digest")
    else:
        # The rows of these digests are few; they are grouped by digest and text instead.
        shared = stored(apart.select("digest").distinct(), "shared-digests")
        read = located(docs).withColumn("digest", key(F.col("text"))).join(shared, "digest", "left_semi")
        first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", *PLACE))
        groups = read.groupBy("digest", "text").agg(first.alias("first"), F.count("*").alias("n"))
        split = read.select("digest", "text", *PLACE).join(groups, ["digest", "text"]).select(*PLACE, "first", "n")
        plain = rows.join(shared, "digest", "left_anti").join(state, "digest")
        judged = plain.unionByName(rows.join(stored(split, "split-groups"), PLACE).select(*plain.columns))
    first = F.col("first")
    return judged.select(
        "doc_id",
        *PLACE,
        first["doc_id"].alias("keep_id"),
        F.col("n").alias("group_size"),
        ((F.col("file") == first["file"]) & (F.col("place") == first["place"])).alias("kept"),
        F.lower(F.hex("sha256")).alias("text_sha256"),
    )
