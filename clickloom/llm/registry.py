"""Queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    centroids, decontamination, html_text, mixing, quality, simhash, sql, substring_dedup, token_files,
    token_transducer, url_rules, warc, whitening,
)

TOKEN_LIMIT = 2048
# The host rules; after them this library's own patterns for the hosts they leave open.
URL_RULES = [
    url_rules.Rule("org/", "allow", True), url_rules.Rule("example.org/es/", "block", True),
    url_rules.Rule("example.org/en/1", "block", True), url_rules.Rule("com/fr/", "allow", True),
    url_rules.Rule("com/de/", "block", True),
    *(url_rules.Rule(text, "block") for text in (
        "||casino-", "||free-bets.", "||cheap-pills.", "||spam-", "||adult-", "||ads-track.")),
]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without repeated passages."""
    made = substring_dedup.remove_repeats(_table(spark, folder, "documents"))
    return made.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold benchmark items, with alignment scores."""
    return decontamination.leak_report(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    )


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base statistics and verdict of every document."""
    return quality.rules_report(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Token files of every document, written and read back."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return token_files.token_report(_table(spark, folder, "documents"), tokenizer, end_id=1)


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token count of every document."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    counts = token_transducer.count_tokens(_table(spark, folder, "documents"), tokenizer)
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix_report(_table(spark, folder, "documents"))


def op8_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """Visible text of every page."""
    return html_text.extract(_table(spark, folder, "pages"))


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    return quality.quality_report(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Archive of every page, written and read back."""
    return warc.archive_report(_table(spark, folder, "pages"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Whitened components of every embedding; a deviation beyond a long is NULL."""
    made = whitening.whiten(_table(spark, folder, "embeddings"))
    return made.withColumn("deviation", F.col("deviation").try_cast("bigint"))


def op12_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on the URL of every page."""
    pages = _table(spark, folder, "pages").select("page_id", "url")
    judged = url_rules.judge(pages, url_rules.rule_frame(pages, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict", "pattern")


def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Cluster of every embedding of 64 components."""
    return centroids.cluster_vectors(_table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_quality_rules": op3_quality_rules,
    "op4_token_files": op4_token_files,
    "op5_simhash": op5_simhash,
    "op6_token_counts": op6_token_counts,
    "op7_mixing": op7_mixing,
    "op8_html_text": op8_html_text,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_warc": op10_warc,
    "op11_whitening": op11_whitening,
    "op12_url_rules": op12_url_rules,
    "op13_centroids": op13_centroids,
}

ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": sql.SUBSTRING_DEDUP,
    "op7_mixing": sql.MIXING,
    "op10_warc": sql.WARC,
    "op12_url_rules": sql.URL_RULES,
    "op13_centroids": sql.CENTROIDS,
}
