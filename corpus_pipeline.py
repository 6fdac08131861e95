"""A training-corpus pipeline over ``documents``, one stage per operator.

Every stage gets what the one before it wrote. Benchmark items and labels come from the
tables' folder; the tokenizer's file is a parameter of the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.llm import decontamination, passages, sentencepiece_codec, simhash, toxicity
from quotemill.llm.tables import read
from quotemill.session import stored


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    # The score takes the place of a column of that name: the table's columns go under plain names.
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.toDF(*at.values()).withColumnRenamed(at["text"], "text")
    scored = toxicity.score(plain, toxicity.fit(docs, labels))
    return scored.where(F.col("score") < 0.5).drop("score").toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.drop_near_duplicates(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that near-duplicate one of an earlier document."""
    return passages.drop_repeated_passages(docs)


def cut_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without phrases of the benchmark."""
    return decontamination.remove(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    return sentencepiece_codec.round_trip_digest(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash", drop_near_copies),
    ("passages", cut_repeated_passages),
    ("decontamination", cut_benchmark_text),
    ("sentencepiece", encode),
]

#: Classifier, fingerprints and tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
