"""Regression metrics, quality gate and performance monitoring."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.binning import as_day, label_of
from ..functions.pricing import ratio, rounded
from ..rules import TERCILE_LABELS
from .ordered import exact_percentiles


def regression_metrics(
    df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()
) -> DataFrame:
    """rmse, mae, mape (rows with a zero actual do not count for mape) and row count."""
    error = F.col(actual) - F.col(predicted)
    share = F.abs(ratio(error, F.col(actual)))
    return df.groupBy(*by).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.avg(share) * 100).alias("mape"),
        F.count(F.lit(1)).alias("n_asins"),
    )


def quality_gate(
    metrics: DataFrame, max_rmse: float | None = None, max_mape: float | None = None
) -> DataFrame:
    """Metrics with ``passed`` and ``message``; an absent threshold always passes.

    Metrics of no rows never pass.
    """
    # The texts of the verdict.
    verdict = F.lit("All quality gates passed")
    failed = F.lit(False)
    if max_mape is not None:
        over = F.col("mape") > max_mape
        failed = failed | F.coalesce(over, F.lit(False))
        text = F.format_string(f"MAPE %.2f%% exceeds threshold {max_mape}%%", F.col("mape"))
        verdict = F.when(over, text).otherwise(verdict)
    if max_rmse is not None:
        over = F.col("rmse") > max_rmse
        failed = failed | F.coalesce(over, F.lit(False))
        text = F.format_string(f"RMSE %.4f exceeds threshold {max_rmse}", F.col("rmse"))
        verdict = F.when(over, text).otherwise(verdict)
    if "n_asins" in metrics.columns:
        nothing = F.col("n_asins") == 0
        failed = failed | nothing
        verdict = F.when(nothing, "No rows to evaluate").otherwise(verdict)
    return metrics.select("*", (~failed).alias("passed"), verdict.alias("message"))


def recent_predictions(
    predictions: DataFrame, day: str | date, lookback: int = 7
) -> DataFrame:
    """Predictions of the last ``lookback`` days up to ``day``."""
    end = as_day(day)
    past = predictions.where(F.col("scrape_date") <= F.lit(end))
    return past.where(F.col("scrape_date") > F.lit(end - timedelta(days=lookback)))


def daily_model_metrics(
    predictions: DataFrame, day: str | date, lookback: int = 7
) -> DataFrame:
    rows = recent_predictions(predictions, day, lookback)
    return regression_metrics(rows, "current_price", "predicted_price", ["scrape_date"])


def performance_alert(daily: DataFrame, mape_alert: float = 15.0) -> DataFrame:
    """Unweighted means of the daily metrics, a status and the alert flag."""
    mean = daily.agg(
        F.avg("mape").alias("rolling_mape"),
        F.avg("rmse").alias("rolling_rmse"),
        F.avg("mae").alias("rolling_mae"),
        F.count(F.lit(1)).alias("days"),
    )
    alert = F.coalesce(F.col("rolling_mape") > mape_alert, F.lit(False))
    status = (
        F.when(F.col("days") == 0, "skipped — no predictions")
        .when(alert, "degraded")
        .otherwise("healthy")
    )
    return mean.select("*", alert.alias("alert_triggered"), status.alias("status"))


def residuals(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    error = F.col(actual) - F.col(predicted)
    return df.select(
        "asin",
        "scrape_date",
        F.col(actual).alias("actual"),
        F.col(predicted).alias("predicted"),
        error.alias("residual"),
        F.abs(error).alias("abs_residual"),
        "current_price",
    )


def residuals_by_tercile(residual_rows: DataFrame) -> DataFrame:
    """Mean absolute residual of the low, middle and high third of prices."""
    cuts = exact_percentiles(
        residual_rows, [], "current_price", {"_low": 1 / 3, "_high": 2 / 3}
    )
    price = F.round("current_price", 6)
    index = (
        F.when(price <= F.round("_low", 6), 0)
        .when(price <= F.round("_high", 6), 1)
        .when(price.isNotNull(), 2)
    )
    return (
        residual_rows.crossJoin(F.broadcast(cuts))
        .groupBy(label_of(index, TERCILE_LABELS).alias("price_bucket"))
        .agg(F.avg("abs_residual").alias("mean_abs_residual"), F.count(F.lit(1)).alias("rows"))
    )


def worst_predictions(residual_rows: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` largest absolute errors."""
    return residual_rows.orderBy(
        F.desc(F.round("abs_residual", 6)), "asin", "scrape_date"
    ).limit(k)


def prediction_view(predictions: DataFrame) -> DataFrame:
    return predictions.select(
        "asin",
        "scrape_date",
        rounded(F.col("current_price"), 2).alias("current"),
        rounded(F.col("predicted_price"), 2).alias("predicted"),
        rounded(F.col("price_diff_pct"), 2).alias("diff_pct"),
        "model_version",
    )
