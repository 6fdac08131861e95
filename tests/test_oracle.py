"""Every registered query runs, and equals its SQL where it has one."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SF
from tests.harness import compare, duck

MODEL_QUERIES = {
    "gbt_predictions", "gbt_feature_importances", "ridge_metrics", "model_leaderboard",
    "parameter_sweep", "learning_curve", "model_lifecycle",
}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert compare(queries()[name](spark, SF), con, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql()) - MODEL_QUERIES))
def test_query_without_sql_has_rows(spark, name):
    assert queries()[name](spark, SF).collect()


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "suggested_price" in df.columns


def test_sql_belongs_to_queries():
    assert set(oracle_sql()) <= set(queries())
