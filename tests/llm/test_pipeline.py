from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from quotemill.llm.queries import QUERIES
from tests.conftest import SF


def test_every_operator_is_registered():
    names = {n.split("_")[0] for n in queries() if n.startswith("op")}
    assert names == {f"op{n}" for n in range(1, 14)} and "pipeline" in queries()
    assert {n for n in oracle_sql() if n in QUERIES} <= {"op11_merkle", "op12_minhash_forest", "op13_conversations"}


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts, current = docs.columns, [docs.count()], docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, SF)
        assert current.columns == columns
        counts.append(current.count())
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[2] == counts[3] == counts[4]


def test_run_equals_its_stages_on_a_folder_without_rows(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert result.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and result.collect() == []


def test_rejection_keeps_a_column_named_like_its_result(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit(7))
    left = corpus_pipeline.reject_toxic(spark, docs, SF)
    assert left.columns == docs.columns and 0 < left.where("score = 7").count() < docs.count()
