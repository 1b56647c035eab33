"""A corpus pipeline: documents through five operators, each stage on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reliq.llm import bpe, contamination, jaccard, lines, quality
from reliq.llm.queries import id_digest, vocabulary_path
from reliq.llm.text import documents
from reliq.session import configure, fresh_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no rule of the newest policy.

    Null and empty texts have too few words and go. Rows that repeat are judged one by one, alike.
    """
    configure(spark)
    return quality.apply_policy(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated lines; ``n_chars`` follows the text.

    A null text becomes the empty text, one empty line. Every row stays; of rows that share an id,
    a null one included, each counts as a document that holds its lines.
    """
    configure(spark)
    kept = lines.drop_repeated_lines(docs).select("row", F.col("kept").alias("text"))
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return kept.select(*[changed.get(name, F.col("row")[name]).alias(name) for name in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id.

    Documents without words are linked with nothing and stay, and so do null and empty texts.
    """
    configure(spark)
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item.

    Null and empty texts have no words and stay; without items, or without words in them, all do.
    """
    configure(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination.contamination(docs, items).filter("n_hit = 0").select("row.*")


def bpe_coding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its token ids and the digest of the text that they decode to.

    A null text has the tokens of the empty text, none. Rows that repeat are coded alike.
    """
    configure(spark)
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), vocabulary_path())
    return coded.select(
        "row.*",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        id_digest("ids").alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("bpe_coding", bpe_coding),
]

#: The last stage has no SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again."""
    configure(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = fresh_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
