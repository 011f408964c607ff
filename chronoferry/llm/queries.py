"""The registered queries of this folder, one for each operator, over whole tables; and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from chronoferry.config import fresh_folder
from chronoferry.llm import (
    byte_pairs,
    decontaminate,
    embeddings,
    hard_negatives,
    language_model,
    licences,
    periodic_runs,
    pieces,
    quality,
    rollups,
    sharding,
    simhash,
    training_order,
)


# The source whose byte counts the token-count query takes back.
WITHDRAWN = "src5"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(pieces.coded(_table(spark, sf_dir, "documents")))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return seen.select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, _table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        quality.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op8_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each sequence of all documents is, with a checksum of what its shard's file has there."""
    folder = fresh_folder(spark, "order")
    placed = training_order.materialise(_table(spark, sf_dir, "documents"), folder)
    records = training_order.read_shards(spark, folder).select("slot", F.crc32("record").alias("record_crc32"))
    return placed.join(records, "slot", "left")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of whole documents, written and read again; what is shown of the texts is computed from the files."""
    folder = fresh_folder(spark, "shards")
    sharding.write(spark, _table(spark, sf_dir, "documents"), folder)
    return spark.read.parquet(folder).select(
        "doc_id",
        F.col("shard_size").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by source, language and tokenizer after four batches over all documents: their bytes as
    tokens, estimated tokens, exact tokens that revise the estimates (committed twice), and a deletion of
    the byte counts of the documents of one source."""
    docs = _table(spark, sf_dir, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    ledger = rollups.Ledger(spark, fresh_folder(spark, "rollups"))
    ledger.commit("bytes", rollups.changes(docs, "insert", "bytes", size, size))
    guess = F.ceil(size / 3)
    ledger.commit("estimates", rollups.changes(docs, "insert", "piece_bpe_32k", guess, size))
    exact = rollups.counted(docs.select("source", "lang", "text", size.alias("size")))
    guess = F.ceil(F.col("size") / 3)
    exact = rollups.changes(exact, "revise", "piece_bpe_32k", F.col("tokens"), F.col("size"), guess, F.col("size"))
    for _ in range(2):
        ledger.commit("exact counts", exact)
    ledger.commit("withdrawn", rollups.changes(docs.where(F.col("source") == WITHDRAWN), "delete", "bytes", size, size))
    return ledger.totals()


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of whole documents, a tenth of which has had repeats put in."""
    docs = periodic_runs.with_repeats(_table(spark, sf_dir, "documents"))
    return periodic_runs.digest(periodic_runs.runs(docs))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh vector has another label than its own."""
    ident, label = F.col("vec_id"), F.col("label")
    vectors = _table(spark, sf_dir, "embeddings")
    vectors = vectors.withColumn("label", F.when(ident % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.mine(vectors, ident % 100 == 0)


def op13_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_pairs.digest(byte_pairs.coded(_table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embeddings": op1_embeddings,
    "op2_licences": op2_licences,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_decontamination": op4_decontamination,
    "op5_language_model": op5_language_model,
    "op6_simhash": op6_simhash,
    "op7_quality": op7_quality,
    "op8_training_order": op8_training_order,
    "op9_sharding": op9_sharding,
    "op10_token_counts": op10_token_counts,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_byte_pairs": op13_byte_pairs,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op1_embeddings": """
        WITH RECURSIVE usable AS (
            SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
            ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
        ),
        reach AS (
            SELECT vec_id AS a, vec_id AS b FROM embeddings
            UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
        ),
        classes AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
        counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
        FROM embeddings e JOIN classes ON classes.a = e.vec_id LEFT JOIN counts ON counts.a = e.vec_id
    """,
    "op12_hard_negatives": """
        WITH usable AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scores AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                   list_dot_product(a.v, b.v)::BIGINT AS score
            FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
        ),
        positives AS (
            SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
        )
        SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
               row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank
        FROM positives JOIN scores USING (anchor_id)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
        QUALIFY rank <= 5
    """,
}
