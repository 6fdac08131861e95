"""Drift and performance monitoring against stored tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import SparkSession

from ..functions.binning import as_day
from ..operators.drift import drift_report, drift_summary
from ..operators.metrics import daily_model_metrics, performance_alert
from ..schemas import GOLD_PRICE_FEATURES, GOLD_PRICE_PREDICTIONS
from ..session import stored
from ..sinks.tables import log_metrics, log_parameters, read_table


def monitor_drift(
    spark: SparkSession,
    root: str,
    day: str | date = "",
    lookback: int = 30,
    p_thresh: float = 0.05,
    mean_thresh: float = 20.0,
) -> dict:
    """Log the drift of every feature; the report has one row per feature."""
    run_day = as_day(day)
    gold = read_table(spark, root, GOLD_PRICE_FEATURES)
    report = stored(drift_report(gold, run_day, lookback, p_thresh, mean_thresh), "drift_report")
    summary = drift_summary(report).first().asDict()
    rows = report.collect()
    run = f"data_drift_{run_day.isoformat()}"
    log_parameters(spark, root, run, {"lookback": lookback, "p_thresh": p_thresh, "mean_thresh": mean_thresh})
    log_metrics(
        spark,
        root,
        run,
        {
            "drifted_feature_count": summary["drifted_feature_count"],
            **{f"ks_{r['feature']}": r["ks_statistic"] for r in rows},
            **{f"drift_pct_{r['feature']}": r["mean_drift_pct"] for r in rows},
        },
    )
    return {**summary, "report": rows}


def monitor_performance(
    spark: SparkSession,
    root: str,
    day: str | date = "",
    lookback: int = 7,
    mape_alert: float = 15.0,
) -> dict:
    """Log the mean daily accuracy; no predictions in range gives a skipped status."""
    run_day = as_day(day)
    predictions = read_table(spark, root, GOLD_PRICE_PREDICTIONS)
    alert = performance_alert(daily_model_metrics(predictions, run_day, lookback), mape_alert)
    result = alert.first().asDict()
    if result["days"]:
        names = ("rolling_mape", "rolling_rmse", "rolling_mae", "alert_triggered")
        run = f"model_perf_{run_day.isoformat()}"
        log_parameters(spark, root, run, {"lookback": lookback, "mape_alert": mape_alert})
        log_metrics(spark, root, run, {n: result[n] for n in names})
    return result
