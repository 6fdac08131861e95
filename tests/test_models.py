"""Model inputs and models against direct computations."""

import math
from datetime import date, timedelta
from itertools import combinations
from math import lcm

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotemill.operators import models as M
from quotemill.operators.drift import drift_report, ks_p_value, ks_statistics
from quotemill.operators.metrics import regression_metrics
from quotemill.operators.features import fit_medians, impute, mark_split, point_in_time
from quotemill.plans.modelling import prepare
from quotemill.queries import binding as B
from quotemill.rules import MODEL_COLUMNS, TARGET_COLUMN


@pytest.fixture(scope="module")
def split(spark, sf):
    return prepare(B.stored_gold(spark, sf))


def matrix(df):
    rows = df.select(*MODEL_COLUMNS, TARGET_COLUMN).collect()
    data = np.array([[float(v) for v in r] for r in rows])
    return data[:, :-1], data[:, -1]


def test_ridge_is_the_closed_form(split):
    model = M.fit_ridge(split.train, 1.0).stages[-1]
    x, y = matrix(split.train)
    xc, yc = x - x.mean(0), y - y.mean()
    wanted = np.linalg.solve(xc.T @ xc + np.eye(x.shape[1]), xc.T @ yc)
    assert model.coefficients.toArray() == pytest.approx(wanted, abs=1e-6)


def test_boosting_stages_are_single_fits(split):
    """Every tree count of one fit, its path and the sweep agree with fits of that count."""
    params = {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.5, "subsample": 1.0, "colsample": 1.0}
    model = M.fit_gbt(split.train, {**params, "n_estimators": 5})
    path = M.boosting_path(model, split.test)
    stages = M.boosting_stages(model, split.test, (1, 3, 5))
    got = {r.n_estimators: r.rmse for r in regression_metrics(stages, TARGET_COLUMN, M.PREDICTION, ["n_estimators"]).collect()}
    assert got == {n: pytest.approx(path[n - 1]) for n in (1, 3, 5)}
    swept = {(r.n_estimators, r.max_depth): r.rmse for r in M.parameter_sweep(split.train, split.test, (1, 5), (2, 3), params).collect()}
    assert swept.keys() == {(1, 3), (3, 3), (5, 3), (3, 2)}
    assert swept[(5, 3)] == pytest.approx(path[4])
    with pytest.raises(ValueError, match="5 trees"):
        M.boosting_stages(model, split.test, (6,))


def test_sweep_starts_its_longest_fits_first(split, monkeypatch):
    started, plain = [], M.fit_gbt
    monkeypatch.setattr(M, "fit_gbt", lambda train, p: started.append((p["n_estimators"], p["max_depth"])) or plain(train, p))
    params = {"n_estimators": 1, "max_depth": 2, "subsample": 1.0, "colsample": 1.0}
    swept = M.parameter_sweep(split.train, split.test, (1, 2), (1, 2, 3), params, parallelism=1).collect()
    assert started == [(2, 2), (1, 3), (1, 1)]
    assert {(r.n_estimators, r.max_depth) for r in swept} == {(1, 2), (2, 2), (1, 3), (1, 1)}
    alone = regression_metrics(M.predict(plain(split.train, {**params, "max_depth": 3}), split.test), TARGET_COLUMN, M.PREDICTION).first()
    assert {r.max_depth: r.rmse for r in swept if r.max_depth != 2}[3] == pytest.approx(alone.rmse)


def test_learning_curve_prefixes(split):
    curve = M.learning_curve(split.train, split.test, (0.5, 1.0), {"n_estimators": 2, "max_depth": 2}).collect()
    n = split.train.count()
    assert [r.train_rows for r in curve] == [n // 2, n]


def test_untrained_model_raises(split):
    with pytest.raises(RuntimeError, match="fit a model first"):
        M.predict(None, split.test)
    with pytest.raises(RuntimeError, match="fit a model first"):
        M.importances(None)


def test_leaderboard(split):
    board = M.compare_models(split.train, split.test, {"n_estimators": 2}, forest_trees=2, forest_depth=2).collect()
    assert len(board) == 4
    assert [r.rmse for r in board] == sorted(r.rmse for r in board)


def test_split_sizes_and_order(spark):
    rows = [(f"K{i:03d}", date(2024, 1, 1) + timedelta(days=i % 4)) for i in range(50)]
    df = spark.createDataFrame(rows, "asin string, scrape_date date")
    for test_size in (0.2, 0.33, 0.5, 0.0, 1.0):
        marked = mark_split(df, test_size).collect()
        train = [r.scrape_date for r in marked if r.is_train]
        test = [r.scrape_date for r in marked if not r.is_train]
        assert len(train) == int(50 * (1 - test_size))
        assert not train or not test or max(train) <= min(test)


def test_impute_uses_train_medians_and_zero(spark):
    schema = "current_price double, price_momentum double"
    train = spark.createDataFrame([(10.0, None), (20.0, None)], schema)
    medians = fit_medians(train, ["current_price", "price_momentum"])
    test = spark.createDataFrame([(None, None), (3.0, 1.0)], schema)
    assert sorted(map(tuple, impute(test, medians).collect())) == [(3.0, 1.0), (15.0, 0.0)]


def test_point_in_time_ages(spark):
    features = spark.createDataFrame(
        [("A", date(2024, 1, 1), 1.0), ("A", date(2024, 1, 5), 5.0)], "asin string, scrape_date date, v double"
    )
    labels = spark.createDataFrame(
        [("A", d, n) for n, d in enumerate((date(2023, 12, 31), date(2024, 1, 4), date(2024, 1, 5), date(2024, 1, 20)))],
        "asin string, at date, n int",
    )
    got = point_in_time(labels, features, ["v"], "at").orderBy("n").collect()
    assert [r.v for r in got] == [None, 1.0, 5.0, 5.0]
    got = point_in_time(labels, features, ["v"], "at", max_age_days=3).orderBy("n").collect()
    assert [r.v for r in got] == [None, 1.0, 5.0, None]


def brute_p(d, n, m):
    """Share of all arrangements whose statistic is at least d."""
    total = hits = 0
    for chosen in combinations(range(n + m), n):
        i = j = 0
        worst = 0.0
        for k in range(n + m):
            if k in chosen:
                i += 1
            else:
                j += 1
            worst = max(worst, abs(i / n - j / m))
        total += 1
        hits += worst >= d - 1e-12
    return hits / total


@pytest.mark.parametrize("n, m", [(30, 40), (200, 90), (20_000, 15_000)])
def test_p_value_is_one_series_at_every_size(spark, n, m):
    """The limiting law: 2 sum (-1)^(k-1) exp(-2 k^2 lambda^2)."""
    for d in (0.0, 0.001, 0.05, 0.2, 1.0):
        lam = d * math.sqrt(n * m / (n + m))
        wanted = 2 * sum((-1) ** (k - 1) * math.exp(-2 * (k * lam) ** 2) for k in range(1, 101)) if lam >= 0.04 else 1.0
        row = spark.range(1).select(ks_p_value(F.lit(d), F.lit(n), F.lit(m)).alias("p")).first()
        assert row.p == pytest.approx(min(1.0, max(0.0, wanted)), abs=1e-12)


def test_p_value_is_near_enumeration():
    for d, n, m in ((0.5, 6, 5), (0.8, 6, 5)):
        lam = d * math.sqrt(n * m / (n + m))
        series = 2 * sum((-1) ** (k - 1) * math.exp(-2 * (k * lam) ** 2) for k in range(1, 101))
        assert brute_p(d, n, m) == pytest.approx(series, abs=0.15)


def test_ks_statistic(spark):
    rng = np.random.default_rng(3)
    base, new = rng.normal(10, 3, 200).round(1), rng.normal(11, 3, 80).round(1)
    rows = [(float(v), False) for v in base] + [(float(v), True) for v in new]
    df = spark.createDataFrame(rows, "value double, cur boolean").withColumn("feature", F.lit("f"))
    got = ks_statistics(df, ["feature"], "value", "cur").first()
    grid = np.unique(np.concatenate([base, new]))
    wanted = max(abs((base <= g).mean() - (new <= g).mean()) for g in grid)
    assert got.ks_statistic == pytest.approx(wanted)
    assert (got.baseline_rows, got.current_rows) == (200, 80)
    assert got.baseline_mean == pytest.approx(base.mean()) and got.current_mean == pytest.approx(new.mean())


def test_ks_takes_sums_in_another_order_as_ties(spark):
    ends = [float("nan"), float("inf"), float("-inf"), 0.0, 5e-324, 1e308]
    base = [0.1 + (0.2 + 0.3), 1 / 3, 10.0, *ends]
    new = [(0.1 + 0.2) + 0.3, 1 - 2 / 3, 10.000000000000002, *ends]
    assert base[:3] != new[:3]
    apart = [(2.0, False), (2.00000001, True)]
    rows = [("same", v, i > 0) for i, side in enumerate((base, new)) for v in side] + [("apart", *r) for r in apart]
    df = spark.createDataFrame(rows, "feature string, value double, cur boolean")
    got = {r.feature: r.ks_statistic for r in ks_statistics(df, ["feature"], "value", "cur").collect()}
    assert got == {"same": 0.0, "apart": 1.0}


def test_drift_flags(spark):
    day = date(2024, 2, 1)
    rows = [(day - timedelta(days=i % 20 + 1), float(i % 10), 5.0) for i in range(100)]
    rows += [(day, 50.0 + i, 5.0) for i in range(10)]
    df = spark.createDataFrame(rows, "scrape_date date, moved double, still double")
    report = {r.feature: r for r in drift_report(df, day, features=["moved", "still"]).collect()}
    assert report["moved"].drifted and report["moved"].p_value == 0.0
    assert not report["still"].drifted and report["still"].p_value == 1.0
    assert drift_report(df, date(2030, 1, 1), features=["moved"]).isEmpty()
