"""Training, evaluation, promotion and scoring against stored tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.binning import as_day
from ..operators.features import fit_medians, impute, mark_split, time_split, training_frame
from ..operators.metrics import quality_gate, regression_metrics, residuals, worst_predictions
from ..operators.models import PREDICTION, fit_gbt, importances, predict, score
from ..operators.quality import require_columns, require_null_fraction, require_rows
from ..rules import GBT_DEFAULTS, MODEL_COLUMNS, TARGET_COLUMN
from ..schemas import GOLD_PRICE_FEATURES, GOLD_PRICE_PREDICTIONS, OPS_MODEL_VERSIONS
from ..session import literal_rows, stored
from ..sinks.tables import log_metrics, log_parameters, read_table, upsert_table

NEW, PRODUCTION, ARCHIVED = "None", "Production", "Archived"


@dataclass
class Split:
    """Imputed train and test rows with the medians that filled them."""

    train: DataFrame
    test: DataFrame
    medians: DataFrame


def prepare(
    gold: DataFrame, min_history: int = 7, test_size: float = 0.2, compat: bool = False
) -> Split:
    """Validated, split and imputed training data.

    Medians come from the training part and are reused when scoring; ``compat`` fits them
    on all rows instead. Each step that several later ones read is stored once.
    """
    require_columns(gold, [TARGET_COLUMN, "current_price", "comp_median_price", "asin", "scrape_date"])
    frame = stored(training_frame(gold, min_history), "training_frame")
    require_rows(frame, 10, f"(products need {min_history} days of history)")
    marked = stored(mark_split(frame, test_size), "marked")
    medians = fit_medians(marked if compat else marked.where("is_train"), MODEL_COLUMNS)
    medians = stored(medians, "medians")
    filled = stored(impute(marked, medians), "filled")
    return Split(
        filled.where("is_train").drop("is_train"),
        filled.where("NOT is_train").drop("is_train"),
        medians,
    )


def _versions(spark: SparkSession, root: str) -> DataFrame:
    """Newest state of every model version."""
    log = read_table(spark, root, OPS_MODEL_VERSIONS)
    newest = log.groupBy("version").agg(F.max_by(F.struct(*log.columns), "changed_at").alias("r"))
    return newest.select("r.*")


def _record(spark: SparkSession, root: str, version: int, path: str, stage: str, metrics: dict) -> None:
    row = (
        version, path, stage, metrics.get("rmse"), metrics.get("mae"), metrics.get("mape"),
        datetime.now(timezone.utc),
    )
    frame = literal_rows(spark, [row], OPS_MODEL_VERSIONS.schema)
    frame.coalesce(1).write.mode("append").parquet(OPS_MODEL_VERSIONS.path(root))


def latest_version(spark: SparkSession, root: str, stage: str = NEW) -> dict:
    """Newest version in a stage; raises when there is none."""
    row = _versions(spark, root).where(F.col("stage") == stage).orderBy(F.desc("version")).first()
    if row is None:
        raise ValueError(f"No model versions found in stage '{stage}'")
    return row.asDict()


def promote(spark: SparkSession, root: str, version: int, stage: str = PRODUCTION) -> None:
    """Move a version to a stage and archive the version that held it."""
    rows = {r["version"]: r.asDict() for r in _versions(spark, root).collect()}
    for number, row in rows.items():
        if row["stage"] == stage and number != version:
            _record(spark, root, number, row["path"], ARCHIVED, row)
    _record(spark, root, version, rows[version]["path"], stage, rows[version])


def train(
    spark: SparkSession,
    root: str,
    params: dict | None = None,
    min_history: int = 7,
    test_size: float = 0.2,
) -> dict:
    """Fit, log and register a new version; returns its number, metrics and importances."""
    split = prepare(read_table(spark, root, GOLD_PRICE_FEATURES), min_history, test_size)
    model = fit_gbt(split.train, params)
    metrics = regression_metrics(predict(model, split.test), TARGET_COLUMN, PREDICTION).first().asDict()
    last = _versions(spark, root).agg(F.max("version")).first()[0] or 0
    version = last + 1
    path = f"{OPS_MODEL_VERSIONS.path(root)}_artifacts/{version}"
    model.write().overwrite().save(f"{path}/model")
    split.medians.write.mode("overwrite").parquet(f"{path}/medians")
    _record(spark, root, version, path, NEW, metrics)
    used = {**GBT_DEFAULTS, **(params or {}), "min_history": min_history, "test_size": test_size}
    log_parameters(spark, root, f"train_v{version}", used)
    weights = {r["feature"]: r["importance"] for r in importances(model).collect()}
    values = {k: metrics[k] for k in ("rmse", "mae", "mape")}
    log_metrics(spark, root, f"train_v{version}", {**values, **{f"importance_{k}": v for k, v in weights.items()}})
    return {"version": version, **values, "importances": weights}


def load_version(spark: SparkSession, version: dict) -> tuple[PipelineModel, DataFrame]:
    return (
        PipelineModel.load(f"{version['path']}/model"),
        spark.read.parquet(f"{version['path']}/medians"),
    )


def evaluate(
    spark: SparkSession,
    root: str,
    max_rmse: float | None = 10.0,
    max_mape: float | None = 15.0,
    auto_promote: bool = True,
    min_history: int = 7,
    test_size: float = 0.2,
) -> dict:
    """Gate the newest unpromoted version on the held-out rows; promote it or raise."""
    version = latest_version(spark, root, NEW)
    model, medians = load_version(spark, version)
    frame = training_frame(read_table(spark, root, GOLD_PRICE_FEATURES), min_history)
    _, test = time_split(stored(frame, "evaluation_frame"), test_size)
    require_rows(test, 1, "(held-out rows of the quality gate)")
    scored = predict(model, impute(test, medians))
    verdict = quality_gate(
        regression_metrics(scored, TARGET_COLUMN, PREDICTION), max_rmse, max_mape
    ).first()
    worst = worst_predictions(residuals(scored, TARGET_COLUMN, PREDICTION)).collect()
    if not verdict["passed"]:
        raise ValueError(f"Quality gate FAILED: {verdict['message']}")
    if auto_promote:
        promote(spark, root, version["version"])
    return {**verdict.asDict(), "version": version["version"], "worst": worst}


def score_day(spark: SparkSession, root: str, day: str | date = "") -> dict:
    """Score one day's gold rows with the production model and upsert the predictions."""
    run_day = as_day(day)
    version = latest_version(spark, root, PRODUCTION)
    model, medians = load_version(spark, version)
    gold = read_table(spark, root, GOLD_PRICE_FEATURES).where(F.col("scrape_date") == F.lit(run_day))
    require_rows(gold, 1, f"(scoring {run_day.isoformat()})")
    rows = score(model, gold, medians, str(version["version"]))
    return upsert_table(rows, GOLD_PRICE_PREDICTIONS, root, run_day.isoformat())


def check_completeness(gold: DataFrame, max_null_fraction: float = 0.5) -> None:
    require_null_fraction(gold, MODEL_COLUMNS, max_null_fraction)
