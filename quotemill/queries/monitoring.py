"""Metrics, gate, drift and model-input queries that have a SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift as D
from ..operators import metrics as M
from ..operators.features import (
    fit_medians,
    impute,
    mark_split,
    sequence_windows,
    standardise,
    standardise_sequences,
    training_frame,
)
from ..operators.gram import PREDICTION, gram, ridge, ridge_learning_curve
from ..operators.models import naive_baseline
from ..plans.modelling import prepare
from ..rules import FEATURE_COLUMNS, MODEL_COLUMNS, TARGET_COLUMN, TERCILE_LABELS
from ..session import stored
from . import binding as B
from .oracle import chain, decimals, r6
from .registry import query

_DATE = "CAST(scrape_date AS VARCHAR) AS scrape_date"

_METRICS = (
    f"{r6('sqrt(avg((current_price - predicted_price) * (current_price - predicted_price)))')} AS rmse, "
    f"{r6('avg(abs(current_price - predicted_price))')} AS mae, "
    f"{r6('avg(abs((current_price - predicted_price) / nullif(current_price, 0))) * 100')} AS mape, count(*) AS n_asins"
)


@query("price_predictions_naive", chain(f"SELECT asin, {_DATE}, {r6('predicted_price')} AS predicted_price, {r6('current_price')} AS current_price, {r6('price_diff_pct')} AS price_diff_pct, model_version FROM pred"))
def price_predictions_naive(spark, sf):
    return B.predictions(spark, sf)


@query(
    "prediction_view",
    chain(
        f"SELECT asin, {_DATE}, {decimals('current_price', 2)} AS current, {decimals('predicted_price', 2)} AS predicted, "
        f"{decimals('price_diff_pct', 2)} AS diff_pct, model_version FROM pred"
    ),
)
def prediction_view(spark, sf):
    return M.prediction_view(B.predictions(spark, sf))


@query("regression_metrics", chain(f"SELECT {_METRICS} FROM pred"))
def regression_metrics(spark, sf):
    return M.regression_metrics(B.predictions(spark, sf), "current_price", "predicted_price")


_PLAIN = {
    "m": "SELECT sqrt(avg((current_price - predicted_price) * (current_price - predicted_price))) AS rmse, "
    "avg(abs((current_price - predicted_price) / nullif(current_price, 0))) * 100 AS mape FROM pred"
}


@query(
    "quality_gate",
    chain(
        f"SELECT {r6('rmse')} AS rmse, {r6('mape')} AS mape, NOT (rmse > 10.0 OR mape > 15.0) AS passed, "
        "CASE WHEN rmse > 10.0 THEN 'RMSE ' || format('{:.4f}', rmse) || ' exceeds threshold 10.0' "
        "WHEN mape > 15.0 THEN 'MAPE ' || format('{:.2f}', mape) || '% exceeds threshold 15.0%' "
        "ELSE 'All quality gates passed' END AS message FROM m",
        **_PLAIN,
    ),
)
def quality_gate(spark, sf):
    metrics = M.regression_metrics(B.predictions(spark, sf), "current_price", "predicted_price")
    return M.quality_gate(metrics, max_rmse=10.0, max_mape=15.0).drop("mae", "n_asins")


_RECENT = f"pred WHERE scrape_date <= DATE '{B.DAY}' AND scrape_date > DATE '{B.DAY}' - INTERVAL 7 DAY"


@query("daily_model_metrics", chain(f"SELECT {_DATE}, {_METRICS} FROM {_RECENT} GROUP BY scrape_date"))
def daily_model_metrics(spark, sf):
    return M.daily_model_metrics(B.predictions(spark, sf), B.DAY)


_DAILY = {
    "daily": "SELECT scrape_date, sqrt(avg((current_price - predicted_price) * (current_price - predicted_price))) AS rmse, "
    "avg(abs(current_price - predicted_price)) AS mae, "
    f"avg(abs((current_price - predicted_price) / nullif(current_price, 0))) * 100 AS mape FROM {_RECENT} GROUP BY scrape_date"
}


@query(
    "performance_alert",
    chain(
        f"SELECT {r6('avg(mape)')} AS rolling_mape, {r6('avg(rmse)')} AS rolling_rmse, {r6('avg(mae)')} AS rolling_mae, count(*) AS days, "
        "coalesce(avg(mape) > 15.0, FALSE) AS alert_triggered, CASE WHEN count(*) = 0 THEN 'skipped — no predictions' "
        "WHEN avg(mape) > 15.0 THEN 'degraded' ELSE 'healthy' END AS status FROM daily",
        **_DAILY,
    ),
)
def performance_alert(spark, sf):
    return M.performance_alert(M.daily_model_metrics(B.predictions(spark, sf), B.DAY))


_RES = {
    "res": "SELECT asin, scrape_date, current_price AS actual, predicted_price AS predicted, "
    "current_price - predicted_price AS residual, abs(current_price - predicted_price) AS abs_residual, current_price FROM pred"
}


def _residuals(spark, sf):
    return M.residuals(B.predictions(spark, sf), "current_price", "predicted_price")


@query(
    "worst_predictions",
    chain(
        f"SELECT asin, {_DATE}, {r6('actual')} AS actual, {r6('predicted')} AS predicted, {r6('residual')} AS residual, {r6('abs_residual')} AS abs_residual, {r6('current_price')} AS current_price "
        "FROM res ORDER BY round(res.abs_residual, 6) DESC, asin, res.scrape_date LIMIT 5",
        **_RES,
    ),
)
def worst_predictions(spark, sf):
    return M.worst_predictions(_residuals(spark, sf))


@query(
    "residual_buckets",
    chain(
        f"SELECT CASE WHEN round(current_price, 6) <= q1 THEN '{TERCILE_LABELS[0]}' WHEN round(current_price, 6) <= q2 THEN '{TERCILE_LABELS[1]}' "
        f"ELSE '{TERCILE_LABELS[2]}' END AS price_bucket, {r6('avg(abs_residual)')} AS mean_abs_residual, count(*) AS rows FROM res CROSS JOIN "
        "(SELECT round(quantile_cont(current_price, 1.0/3), 6) AS q1, round(quantile_cont(current_price, 2.0/3), 6) AS q2 FROM res) GROUP BY 1",
        **_RES,
    ),
)
def residual_buckets(spark, sf):
    return M.residuals_by_tercile(stored(_residuals(spark, sf), "residuals"))


# --- model inputs ---------------------------------------------------------------------

_TRAIN = {
    "tf": "SELECT *, CAST(isodow(scrape_date) - 1 AS INTEGER) AS day_of_week, current_price / nullif(comp_median_price, 0) AS price_to_median_ratio "
    "FROM (SELECT * FROM gold WHERE suggested_price IS NOT NULL AND current_price IS NOT NULL AND comp_median_price IS NOT NULL) "
    "QUALIFY count(*) OVER (PARTITION BY asin) >= 7",
}
_MEDIANS = {
    **_TRAIN,
    "med": "SELECT " + ", ".join(f"median(CAST({c} AS DOUBLE)) AS {c}" for c in MODEL_COLUMNS) + " FROM tf",
}


def _frame(spark, sf):
    return stored(training_frame(B.stored_gold(spark, sf)), "training_frame")


@query("impute_median", chain("SELECT " + ", ".join(f"{r6(c)} AS {c}" for c in MODEL_COLUMNS) + " FROM med", **_MEDIANS))
def impute_median(spark, sf):
    return fit_medians(_frame(spark, sf))


_FILLED = ", ".join(f"{r6(f'coalesce(CAST(tf.{c} AS DOUBLE), med.{c}, 0)')} AS {c}" for c in MODEL_COLUMNS)


@query("training_matrix", chain(f"SELECT asin, CAST(scrape_date AS VARCHAR) AS scrape_date, {_FILLED}, suggested_price FROM tf CROSS JOIN med", **_MEDIANS))
def training_matrix(spark, sf):
    frame = _frame(spark, sf)
    return impute(frame, fit_medians(frame)).select("asin", "scrape_date", *MODEL_COLUMNS, "suggested_price")


@query(
    "time_split",
    chain(
        f"SELECT asin, {_DATE}, row_number() OVER (ORDER BY tf.scrape_date, md5(asin)) <= floor((SELECT count(*) FROM tf) * CAST(0.8 AS DOUBLE)) AS is_train FROM tf",
        **_TRAIN,
    ),
)
def time_split(spark, sf):
    return mark_split(_frame(spark, sf)).select("asin", "scrape_date", "is_train")


@query(
    "naive_baseline",
    chain(
        f"SELECT {r6('sqrt(avg((suggested_price - comp_median_price) * (suggested_price - comp_median_price)))')} AS rmse, "
        f"{r6('avg(abs(suggested_price - comp_median_price))')} AS mae, "
        f"{r6('avg(abs((suggested_price - comp_median_price) / nullif(suggested_price, 0))) * 100')} AS mape, count(*) AS n_asins FROM tf",
        **_TRAIN,
    ),
)
def naive_baseline_query(spark, sf):
    return M.regression_metrics(naive_baseline(_frame(spark, sf)), "suggested_price", "predicted_price")


_SEQ_OVER = "OVER (PARTITION BY asin ORDER BY scrape_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"
_SEQ = {
    "seq": "SELECT asin, scrape_date, suggested_price AS target, "
    + ", ".join(
        f"count({c}) {_SEQ_OVER} AS n{i}, sum({c}) {_SEQ_OVER} AS s{i}, "
        f"lag({c}, 7) OVER (PARTITION BY asin ORDER BY scrape_date) AS first{i}, lag({c}, 1) OVER (PARTITION BY asin ORDER BY scrape_date) AS last{i}"
        for i, c in enumerate(("current_price", "comp_median_price", "comp_pressure_score"))
    )
    + " FROM gold",
    "seqs": "SELECT * FROM seq WHERE n0 = 7 AND n1 = 7 AND n2 = 7 AND target IS NOT NULL",
}
_SEQ_COLUMNS = ", ".join(
    f"{r6(f's{i}')} AS sum{i}, {r6(f'first{i}')} AS first{i}, {r6(f'last{i}')} AS last{i}" for i in range(3)
)


def _digest(windows):
    """Sum, oldest and newest value of each feature of a window."""
    def series_of(i):
        return F.transform("window", lambda step: F.get(step, F.lit(i)))

    columns = []
    for i in range(3):
        series = series_of(i)
        columns += [
            F.aggregate(series, F.lit(0.0), lambda a, v: a + v).alias(f"sum{i}"),
            F.get(series, F.lit(0)).alias(f"first{i}"),
            F.get(series, F.lit(6)).alias(f"last{i}"),
        ]
    return windows.select("asin", "scrape_date", "target", *columns)


@query("sequence_windows", chain(f"SELECT asin, {_DATE}, {r6('target')} AS target, {_SEQ_COLUMNS} FROM seqs", **_SEQ))
def sequence_windows_query(spark, sf):
    return _digest(sequence_windows(B.gold(spark, sf)))


@query("sequence_windows_scaled")
def sequence_windows_scaled(spark, sf):
    windows = stored(sequence_windows(B.gold(spark, sf)), "windows")
    train = mark_split(windows).where("is_train")
    return _digest(standardise_sequences(windows, train, 3))


@query(
    "standardised_features",
    chain(
        f"SELECT asin, {_DATE}, "
        + ", ".join(
            f"{r6(f'({c} - avg({c}) OVER ()) / (stddev_pop({c}) OVER () + CAST(1e-8 AS DOUBLE))')} AS {c}"
            for c in ("current_price", "comp_median_price")
        )
        + " FROM tf",
        **_TRAIN,
    ),
)
def standardised_features(spark, sf):
    frame = _frame(spark, sf).select("asin", "scrape_date", "current_price", "comp_median_price")
    return standardise(frame, ["current_price", "comp_median_price"])


# --- drift ----------------------------------------------------------------------------

_DRIFT = {
    "win": f"SELECT *, scrape_date = DATE '{B.DAY}' AS cur FROM gold WHERE scrape_date >= DATE '{B.DAY}' - INTERVAL 30 DAY "
    f"AND scrape_date <= DATE '{B.DAY}' AND " + " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_COLUMNS),
    "long": " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, cur FROM win" for c in FEATURE_COLUMNS),
    "tot": "SELECT feature, count(*) FILTER (WHERE NOT cur) AS nb, count(*) FILTER (WHERE cur) AS nc, "
    "avg(v) FILTER (WHERE NOT cur) AS mb, avg(v) FILTER (WHERE cur) AS mc FROM long GROUP BY feature",
    "cnt": "SELECT feature, v, count(*) FILTER (WHERE NOT cur) AS b, count(*) FILTER (WHERE cur) AS c FROM long GROUP BY feature, v",
    "cdf": "SELECT feature, sum(b) OVER w AS fb, sum(c) OVER w AS fc FROM cnt WINDOW w AS (PARTITION BY feature ORDER BY v)",
    "ks": "SELECT cdf.feature, max(abs(CAST(fb AS DOUBLE) / nb - CAST(fc AS DOUBLE) / nc)) AS d FROM cdf JOIN tot ON tot.feature = cdf.feature GROUP BY cdf.feature",
}


@query(
    "drift_statistics",
    chain(
        f"SELECT tot.feature, {r6('d')} AS ks_statistic, nb AS baseline_rows, nc AS current_rows, {r6('mb')} AS baseline_mean, {r6('mc')} AS current_mean, "
        f"{r6('CASE WHEN mb <> 0 THEN abs(mc - mb) / abs(mb) * 100 ELSE 0 END')} AS mean_drift_pct "
        "FROM tot JOIN ks ON ks.feature = tot.feature WHERE nb > 0 AND nc > 0",
        **_DRIFT,
    ),
)
def drift_statistics(spark, sf):
    return D.drift_statistics(B.stored_gold(spark, sf), B.DAY)


_P_VALUE = (
    "CASE WHEN lam < 0.04 THEN 1.0 ELSE greatest(0.0, least(1.0, list_sum(list_transform(range(1, 101), "
    "lambda k: (CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2 * pow(k * lam, 2)))))) END"
)
_REPORT = {
    **_DRIFT,
    "stat": "SELECT tot.feature, d, nb, nc, mb, mc, CASE WHEN mb <> 0 THEN abs(mc - mb) / abs(mb) * 100 ELSE 0 END AS drift, "
    "d * sqrt(CAST(nb AS DOUBLE) * nc / (nb + nc)) AS lam FROM tot JOIN ks ON ks.feature = tot.feature WHERE nb > 0 AND nc > 0",
    "tested": f"SELECT *, {_P_VALUE} AS p FROM stat",
    "report": "SELECT *, p < 0.05 OR drift > 20.0 AS drifted FROM tested",
}


@query(
    "drift_report",
    chain(
        f"SELECT feature, {decimals('d', 4)} AS ks_statistic, {decimals('p', 4)} AS p_value, {decimals('mb', 4)} AS baseline_mean, "
        f"{decimals('mc', 4)} AS current_mean, {decimals('drift', 2)} AS mean_drift_pct, drifted FROM report",
        **_REPORT,
    ),
)
def drift_report(spark, sf):
    return D.drift_report(B.stored_gold(spark, sf), B.DAY)


@query(
    "drift_summary",
    chain(
        "SELECT count(*) FILTER (WHERE drifted) AS drifted_feature_count, "
        "coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE drifted), '') AS drifted_features, "
        "CASE WHEN count(*) = 0 THEN 'skipped — insufficient data' WHEN count(*) FILTER (WHERE drifted) > 0 THEN 'drift detected' "
        "ELSE 'no drift' END AS status FROM report",
        **_REPORT,
    ),
)
def drift_summary(spark, sf):
    return D.drift_summary(D.drift_report(B.stored_gold(spark, sf), B.DAY))


# --- linear models ----------------------------------------------------------------------


def _ridge_chain(name: str, train: str) -> dict[str, str]:
    """CTEs that solve ridge with penalty 1 by elimination; ``{name}`` holds means and weights."""
    k = len(MODEL_COLUMNS)
    x = [f"x{i}" for i in range(k)]
    cells = [
        "[" + ", ".join(f"covar_pop({a}, {b}) * count(*)" + (" + 1" if a == b else "") for b in [*x, "y"]) + "]" for a in x
    ]
    steps = {f"{name}_1": f"SELECT [{', '.join(cells)}] AS m FROM filled WHERE {train}"}
    for p in range(1, k + 1):
        pivot = f"m[{p}][{p}]"
        steps[f"{name}_{p + 1}"] = (
            f"SELECT list_transform(m, lambda line, i: CASE WHEN i = {p} THEN list_transform(line, lambda v: v / {pivot}) "
            f"ELSE list_transform(line, lambda v, j: v - line[{p}] / {pivot} * m[{p}][j]) END) AS m FROM {name}_{p}"
        )
    means = ", ".join(f"avg({c}) AS mean_{c}" for c in [*x, "y"])
    weights = ", ".join(f"m[{i + 1}][{k + 1}] AS w{i}" for i in range(k))
    steps[name] = f"SELECT * FROM (SELECT {means}, count(*) AS n FROM filled WHERE {train}) CROSS JOIN (SELECT {weights} FROM {name}_{k + 1})"
    return steps


_GUESS = "mean_y + " + " + ".join(f"w{i} * (x{i} - mean_x{i})" for i in range(len(MODEL_COLUMNS)))
_SPLIT = {
    **_TRAIN,
    "placed": "SELECT *, row_number() OVER (ORDER BY scrape_date, md5(asin)) AS place, count(*) OVER () AS total FROM tf",
    "marked": "SELECT *, place <= floor(total * CAST(0.8 AS DOUBLE)) AS is_train, floor(total * CAST(0.8 AS DOUBLE)) AS train_total FROM placed",
    "tmed": "SELECT " + ", ".join(f"median(CAST({c} AS DOUBLE)) AS {c}" for c in MODEL_COLUMNS) + " FROM marked WHERE is_train",
    "filled": "SELECT marked.asin, marked.scrape_date, is_train, place, train_total, suggested_price AS y, "
    + ", ".join(f"coalesce(CAST(marked.{c} AS DOUBLE), tmed.{c}, 0) AS x{i}" for i, c in enumerate(MODEL_COLUMNS))
    + " FROM marked CROSS JOIN tmed",
}


@query(
    "ridge_metrics",
    chain(
        f"SELECT {r6('sqrt(avg((y - p) * (y - p)))')} AS rmse, {r6('avg(abs(y - p))')} AS mae, "
        f"{r6('avg(abs((y - p) / nullif(y, 0))) * 100')} AS mape, count(*) AS n_asins "
        f"FROM (SELECT y, {_GUESS} AS p FROM filled CROSS JOIN fit WHERE NOT is_train)",
        **_SPLIT,
        **_ridge_chain("fit", "is_train"),
    ),
)
def ridge_metrics(spark, sf):
    split = prepare(B.stored_gold(spark, sf))
    model = ridge(gram(split.train, [*MODEL_COLUMNS, TARGET_COLUMN]))
    return M.regression_metrics(model.predict(split.test), TARGET_COLUMN, PREDICTION)


_FRACTIONS = (0.2, 0.4, 0.6, 0.8, 1.0)


def _curve_sql() -> str:
    steps, selects = dict(_SPLIT), []
    for k, fraction in enumerate(_FRACTIONS):
        prefix = f"is_train AND place <= greatest(2, floor(round(train_total * CAST({fraction} AS DOUBLE), 6)))"
        steps |= _ridge_chain(f"fit{k}", prefix)
        error = "sqrt(avg((y - p) * (y - p)))"
        scored = f"SELECT y, {_GUESS} AS p, n FROM filled CROSS JOIN fit{k}"
        selects.append(
            f"SELECT CAST({fraction} AS DOUBLE) AS fraction, (SELECT max(n) FROM fit{k}) AS train_rows, "
            f"(SELECT {r6(error)} FROM ({scored} WHERE {prefix})) AS train_rmse, (SELECT {r6(error)} FROM ({scored} WHERE NOT is_train)) AS test_rmse"
        )
    return chain(" UNION ALL ".join(selects), **steps)


@query("ridge_learning_curve", _curve_sql())
def ridge_learning_curve_query(spark, sf):
    split = prepare(B.stored_gold(spark, sf))
    return ridge_learning_curve(split.train, split.test, _FRACTIONS)
