"""From raw documents to token ids, in four stages.

    STAGES            (name, function(spark, docs, sf_dir) -> DataFrame), in order
    run(spark, sf_dir) applies them to the documents of a folder

Every stage is written as Parquet to the shared folder and read again by the next one, so a stage that
has ended is never computed twice. The first three drop rows and keep all columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronoferry.config import fresh_folder
from chronoferry.llm import decontaminate, pieces, quality, simhash


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; the labels train the classifier."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (fingerprints of four-word shingles, at most four
    differing bits, as the SimHash operator has them): the one with the smallest id."""
    return simhash.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with proof that they decode to the same text."""
    return pieces.digest(pieces.coded(docs))


STAGES = [
    ("quality classifier", good),
    ("SimHash near-dedup", distinct),
    ("benchmark decontamination", clean),
    ("SentencePiece encoding and decoding", tokens),
]

# Trained trees, XXH64 fingerprints and byte-pair merges have no SQL form; tests hold each stage
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        folder = fresh_folder(spark, "stage")
        stage(spark, rows, sf_dir).write.parquet(folder)
        rows = spark.read.parquet(folder)
    return rows
