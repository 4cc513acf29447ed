"""From raw documents to packed token files: five stages, each over all that the last one kept.

Every stage reads the documents as Parquet, decides on each of them, and all but the last write
documents with the same columns. Stage tables go to the shared folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import decontamination, mixing, quality, simhash, token_files
from clickloom.workspace import work_path


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources take them."""
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, and what they hold of each."""
    return token_files.token_report(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("quality classifier", classify),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix),
    ("token files", tokenize),
]

# Scores of trained trees and XXH64 fingerprints have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; returns the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = work_path(spark, f"stage{number}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
