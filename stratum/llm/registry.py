"""The operators as registered queries over the given tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import (
    decontaminate, hard_negatives, jaccard_join, licenses, line_crf, merkle, ngram_lm, piece_bpe, slots, stable_knn,
    suffix_dedup, token_output, toxicity,
)
from stratum.llm.oracle import ORACLE

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.score_texts(_table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = slots.shard_by_bytes(_table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )


def op3_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stable_knn.nearest(_table(spark, sf_dir, "embeddings"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.digest(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = line_crf.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op10_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    files = token_output.token_files(_table(spark, sf_dir, "documents"), tokenizer)
    return files.select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return left.select(
        "doc_id", "n_bytes", "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def queries() -> dict[str, Query]:
    return {
        "op1_ngram_scores": op1_ngram_scores,
        "op2_sharding": op2_sharding,
        "op3_nearest_vectors": op3_nearest_vectors,
        "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
        "op5_toxicity": op5_toxicity,
        "op6_benchmark_decontamination": op6_benchmark_decontamination,
        "op7_sentencepiece": op7_sentencepiece,
        "op8_quality": op8_quality,
        "op9_license_scan": op9_license_scan,
        "op10_token_id_output": op10_token_id_output,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_suffix_dedup": op13_suffix_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
