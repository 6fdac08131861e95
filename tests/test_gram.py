"""Models from co-moments against direct computations."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotemill.operators import models as L
from quotemill.operators.features import mark_split
from quotemill.operators.gram import Gram, correlations, cut_points, gram, grams, ridge, ridge_learning_curve, scales, segment_of
from quotemill.operators.metrics import regression_metrics
from quotemill.operators.profile import feature_correlation
from quotemill.plans.modelling import prepare
from quotemill.queries import binding as B
from quotemill.rules import MODEL_COLUMNS, TARGET_COLUMN

NAMES = [*MODEL_COLUMNS, TARGET_COLUMN]


@pytest.fixture(scope="module")
def split(spark, sf):
    return prepare(B.stored_gold(spark, sf))


def matrix(df):
    data = np.array([[float(v) for v in r] for r in df.select(*NAMES).collect()])
    return data[:, :-1], data[:, -1]


@pytest.mark.parametrize("alpha", [0.1, 1.0, 50.0])
def test_ridge_is_the_closed_form(split, alpha):
    model = ridge(gram(split.train, NAMES), alpha)
    x, y = matrix(split.train)
    xc, yc = x - x.mean(0), y - y.mean()
    wanted = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    assert model.coefficients == pytest.approx(wanted, rel=1e-6, abs=1e-7)


def test_predictions_and_errors(split):
    model = ridge(gram(split.train, NAMES))
    x, y = matrix(split.test)
    residual = y - model.intercept - x @ model.coefficients
    assert model.squared_error(gram(split.test, NAMES)) == pytest.approx(residual @ residual, rel=1e-6)
    rmse = regression_metrics(model.predict(split.test), TARGET_COLUMN, "predicted_price").first().rmse
    assert rmse == pytest.approx((residual @ residual / len(y)) ** 0.5)
    pipeline = L.predict(L.fit_ridge(split.train), split.test)
    assert rmse == pytest.approx(regression_metrics(pipeline, TARGET_COLUMN, L.PREDICTION).first().rmse, rel=1e-5)


def test_segments_add_up(split):
    parts = grams(split.train, NAMES, F.pmod(F.xxhash64("asin"), F.lit(5)))
    whole, added = gram(split.train, NAMES), sum(list(parts.values())[1:], list(parts.values())[0])
    assert added.n == whole.n
    assert np.allclose(added.mean, whole.mean) and np.allclose(added.moment, whole.moment)


def test_correlations_and_scales(spark, sf):
    gold = B.stored_gold(spark, sf)
    columns = ["current_price", "comp_median_price", "comp_count"]
    table = gram(gold, columns)
    for r in feature_correlation(gold, columns).collect():
        assert correlations(table)[(r.feature_a, r.feature_b)] == pytest.approx(r.r)
    wanted = gold.dropna(subset=columns).agg(F.avg(columns[0]), F.stddev_pop(columns[0])).first()
    assert scales(table)[columns[0]] == pytest.approx(tuple(wanted))


def test_no_rows_and_constant_columns(spark):
    none = gram(spark.createDataFrame([], "a double, b double"), ["a", "b"])
    assert none.n == 0 and none.moment.shape == (2, 2)
    one = gram(spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 9.0), (float("nan"), 1.0)], "a double, b double"), ["a", "b"])
    assert one.n == 2 and np.isnan(correlations(one)[("a", "b")])
    assert isinstance(none + one, Gram) and (none + one).n == 2


def test_cut_points_are_prefixes(spark):
    rows = [(f"K{i:03d}", date(2024, 1, 1) + timedelta(days=min(i % 9, 3))) for i in range(90)]
    df = spark.createDataFrame(rows, "asin string, scrape_date date")
    sizes = [0, 1, 18, 45, 77, 90, 7]
    for size, cut in zip(sizes, cut_points(df, sizes)):
        got = {r.asin for r in df.where(segment_of([cut]) == 0).collect()}
        wanted = {r.asin for r in mark_split(df, 1 - (size + 0.5) / 90).where("is_train").collect()}
        assert len(got) == size and got == wanted


def test_learning_curve_equals_single_fits(split):
    curve = ridge_learning_curve(split.train, split.test, (0.5, 1.0)).collect()
    half = mark_split(split.train, 0.5).where("is_train")
    for row, prefix in zip(curve, (half, split.train)):
        model = L.fit_ridge(prefix)
        for value, rows in ((row.train_rmse, prefix), (row.test_rmse, split.test)):
            wanted = regression_metrics(L.predict(model, rows), TARGET_COLUMN, L.PREDICTION).first().rmse
            assert value == pytest.approx(wanted, rel=1e-4)
