"""The operators bound to the given tables, by query name, and SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.session import scratch_path

from . import conversations, decontamination, log_bilinear, merkle, minhash_forest, multi_index, oracle, passages, quality_attention, sentencepiece_codec, simhash, substring_repeats, token_files, toxicity
from .tables import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    token_files.write_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return token_files.read_digests(spark, folder)


def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_repeats.digest(read(spark, sf_dir, "documents"))


def op4_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_codec.round_trip_digest(read(spark, sf_dir, "documents"), model)


def fold(modulus: int):
    """The documents' fold: crc32 of the id as text."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.linked_documents(read(spark, sf_dir, "documents"))


def op6_quality_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").where(fold(3) != 1).select("doc_id", F.col("quality").alias("label"))
    return quality_attention.score(docs, quality_attention.fit(docs, labels)).select(
        "doc_id",
        (fold(3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").where(fold(5) != 0).select("doc_id", F.col("toxic").alias("label"))
    return toxicity.score(docs, toxicity.fit(docs, labels)).select(
        "doc_id",
        (fold(5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = log_bilinear.fit_and_score(read(spark, sf_dir, "documents"), fold(7) != 2)
    return scored.withColumn("held_out", fold(7) == 2)


def op9_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return multi_index.nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_check(read(spark, sf_dir, "documents"))


def op12_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_forest.with_kept(read(spark, sf_dir, "documents"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_digest(conversations.damaged(read(spark, sf_dir, "conversations")))


QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_token_files": op2_token_files,
    "op3_suffix_array": op3_suffix_array,
    "op4_sentencepiece_codec": op4_sentencepiece_codec,
    "op5_passages": op5_passages,
    "op6_quality_attention": op6_quality_attention,
    "op7_toxicity": op7_toxicity,
    "op8_log_bilinear": op8_log_bilinear,
    "op9_multi_index": op9_multi_index,
    "op10_decontamination": op10_decontamination,
    "op11_merkle": op11_merkle,
    "op12_minhash_forest": op12_minhash_forest,
    "op13_conversations": op13_conversations,
}

ORACLE_SQL: dict[str, str] = {"op11_merkle": oracle.merkle(), "op12_minhash_forest": oracle.minhash()}
