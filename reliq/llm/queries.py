"""The registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reliq.llm import bpe, contamination, edits, exact, jaccard, language, lines, merkle, passages, ppm, quality, secrets, trie
from reliq.llm.text import documents
from reliq.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """A vocabulary file of the installed public tokenizers."""
    from public_tokenizers import path

    return path(name)


def register(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    QUERIES[query.__name__] = run
    return query


@register
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_repeated_lines(documents(spark, sf_dir))
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@register
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.written_ledger(documents(spark, sf_dir), ["doc_id"])
    base = quality.mask_of(quality.BASE_RULES)
    # Documents that only the rule of a row rejects: of the newest policy, one small row per rule.
    alone = quality.ablations(judged).select(F.col("rule").alias("sole_rule"), F.col("alone").alias("n_alone"))
    return judged.withColumn("sole_rule", quality.sole_rule()).join(F.broadcast(alone), "sole_rule", "left").select(
        "row.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (F.col("bits").bitwiseAND(F.lit(base).cast("bigint")) != 0).alias("base_failed"),
        (~quality.failed()).alias("kept"),
        "bits",
        (~quality.failed(1)).alias("kept_by_policy_1"),
        "sole_rule",
        "n_alone",
    )


@register
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    judged = contamination.contamination(documents(spark, sf_dir), items, slack=contamination.SLACK)
    return judged.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near").cast("bigint").alias("n_near"),
        F.sha2(F.array_join("near", ","), 256).alias("near_sha256"),
    )


def id_digest(ids: str):
    """The hash of decimal ids joined by commas."""
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), ","), 256)


@register
def op5_bpe_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), vocabulary_path())
    return coded.select(
        "row.doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        id_digest("ids").alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register
def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(documents(spark, sf_dir))


@register
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    network = language.train(docs.select("doc_id", "lang", "text"))
    judged = language.identify(docs.select("doc_id", "text"), network)
    return judged.select("row.doc_id", language.held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")


@register
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(documents(spark, sf_dir))


@register
def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf_dir).select("doc_id", "text"))
    spans = F.col("spans")

    def count(kind: str):
        here = F.filter(spans, lambda s: s["kind"] == secrets.KINDS.index(kind))
        return F.size(here).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in secrets.KINDS[: secrets.MARKOV]]
    base = F.filter(spans, lambda s: s["kind"] < secrets.MARKOV)
    return found.select(
        "row.doc_id",
        *counts,
        F.sha2(secrets.written(base), 256).alias("base_sha256"),
        secrets.written(spans).alias("spans"),
    )


@register
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.shared_passages(documents(spark, sf_dir))


@register
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    trees = edits.write_trees(documents(spark, sf_dir).select("doc_id", "text"), vocabulary_path())
    counted = edits.edit_trees(trees, edits.standard_edits(F.col("text")), vocabulary_path(), keep_trees=False)
    return counted.select(
        "row.doc_id",
        "n_tokens",
        "n_pretokens",
        "n_tokens_edited",
        "n_reencoded",
        F.sha2("text", 256).alias("edited_sha256"),
    )


@register
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@register
def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.outcome(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@register
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir))
