"""Price models on pyspark.ml: fit, predict, compare, score."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.pricing import ratio
from ..rules import GBT_DEFAULTS, MODEL_COLUMNS, SWEPT_DEPTHS, SWEPT_TREES, TARGET_COLUMN
from ..session import checkpoint_root, literal_rows, stored
from .features import engineered, impute
from .gram import cut_points, gram, ridge, segment_of
from .metrics import regression_metrics
from .ordered import exact_percentiles

PREDICTION = "predicted_price"
_LEAF = re.compile(r"Predict: (\S+)")

_IMPORTANCE = T.StructType(
    [T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())]
)


def _assembled(estimator, train: DataFrame, columns: Sequence[str]) -> PipelineModel:
    checkpoint_root(train.sparkSession)
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features")
    estimator = estimator.setLabelCol(TARGET_COLUMN).setPredictionCol(PREDICTION)
    return Pipeline(stages=[assembler, estimator]).fit(train)


def fit_gbt(
    train: DataFrame, params: dict | None = None, columns: Sequence[str] = tuple(MODEL_COLUMNS)
) -> PipelineModel:
    """Gradient-boosted trees with squared error. ``train`` must be imputed."""
    p = {**GBT_DEFAULTS, **(params or {})}
    trees = GBTRegressor(
        maxIter=p["n_estimators"],
        maxDepth=p["max_depth"],
        stepSize=p["learning_rate"],
        subsamplingRate=p["subsample"],
        featureSubsetStrategy=str(p["colsample"]),
        lossType="squared",
        seed=p["seed"],
        checkpointInterval=10,
    )
    return _assembled(trees, train, columns)


def fit_forest(
    train: DataFrame,
    trees: int = 100,
    depth: int = 6,
    seed: int = 42,
    columns: Sequence[str] = tuple(MODEL_COLUMNS),
) -> PipelineModel:
    forest = RandomForestRegressor(numTrees=trees, maxDepth=depth, seed=seed)
    return _assembled(forest, train, columns)


def fit_ridge(
    train: DataFrame, alpha: float = 1.0, columns: Sequence[str] = tuple(MODEL_COLUMNS)
) -> PipelineModel:
    """Closed-form ridge regression with penalty ``alpha`` on the plain coefficients.

    Spark averages the loss and scales the label by its deviation, so its ``regParam``
    for the same solution is ``alpha * std(label) / n``.
    """
    scale = train.agg(F.stddev_pop(TARGET_COLUMN).alias("dev"), F.count(F.lit(1)).alias("n")).first()
    linear = LinearRegression(
        elasticNetParam=0.0,
        regParam=alpha * (scale["dev"] or 0.0) / max(scale["n"], 1),
        standardization=False,
        solver="normal",
    )
    return _assembled(linear, train, columns)


def predict(model: PipelineModel | None, df: DataFrame) -> DataFrame:
    if model is None:
        raise RuntimeError("fit a model first")
    return model.transform(df).drop("features")


def naive_baseline(df: DataFrame, train: DataFrame | None = None) -> DataFrame:
    """Predict the competitor median; rows without one get the overall median."""
    source = df if train is None else train
    overall = exact_percentiles(source, [], "comp_median_price", {"_overall": 0.5})
    guess = F.coalesce("comp_median_price", "_overall")
    return df.crossJoin(F.broadcast(overall)).withColumn(PREDICTION, guess).drop("_overall")


def importances(model: PipelineModel | None, columns: Sequence[str] = tuple(MODEL_COLUMNS)) -> DataFrame:
    """(feature, importance), largest first; one row per model input."""
    if model is None:
        raise RuntimeError("fit a model first")
    spark = SparkSession.active()
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(w)) for name, w in zip(columns, weights)]
    frame = literal_rows(spark, rows, _IMPORTANCE)
    return frame.orderBy(F.desc("importance"), "feature")


def _one_row(metrics: DataFrame, **labels) -> DataFrame:
    named = [F.lit(value).alias(name) for name, value in labels.items()]
    return metrics.select(*named, "rmse", "mae", "mape")


def _together(jobs: Sequence[Callable], parallelism: int) -> list:
    """Results of independent fits, several at a time: a fit is many short jobs."""
    with ThreadPool(min(parallelism, max(1, len(jobs)))) as pool:
        return pool.map(inheritable_thread_target(lambda job: job()), jobs)


def compare_models(
    train: DataFrame,
    test: DataFrame,
    gbt: dict | None = None,
    forest_trees: int = 100,
    forest_depth: int = 6,
    alpha: float = 1.0,
    parallelism: int = 4,
) -> DataFrame:
    """Leaderboard of the naive baseline, boosting, ridge and forest, best rmse first."""
    boosted, forest = _together(
        [lambda: fit_gbt(train, gbt), lambda: fit_forest(train, forest_trees, forest_depth)], parallelism
    )
    linear = ridge(gram(train, [*MODEL_COLUMNS, TARGET_COLUMN]), alpha)
    scored = {
        "Naive baseline": naive_baseline(test),
        "Gradient boosting": predict(boosted, test),
        "Ridge": linear.predict(test, PREDICTION),
        "Random forest": predict(forest, test),
    }
    rows = [
        _one_row(regression_metrics(df, TARGET_COLUMN, PREDICTION), model=name)
        for name, df in scored.items()
    ]
    return reduce(DataFrame.unionByName, rows).orderBy("rmse")


def _leaf_values(trees) -> list[tuple[int, int, float]]:
    """(tree, leaf, prediction): leaves numbered from left to right, as a model's leaf column does."""
    found = []
    for t, tree in enumerate(trees):
        values = [float(v) for v in _LEAF.findall(tree.toDebugString)]
        found += [(t, leaf, value) for leaf, value in enumerate(values)]
    return found


def boosting_stages(model: PipelineModel, df: DataFrame, counts: Sequence[int]) -> DataFrame:
    """``df`` once per count, with the prediction of that many first trees and ``n_estimators``.

    One fit gives the whole path: each row finds its leaf in every tree by one transform,
    and the leaves' weighted values are summed up to each count. The table of leaves has at
    most trees x 2^depth rows, which bounds its broadcast.
    """
    spark = df.sparkSession
    booster = model.stages[-1].copy({model.stages[-1].leafCol: "_leaves"})
    weights = booster.treeWeights
    counts = sorted(counts)
    if counts[-1] > len(weights):
        raise ValueError(f"the model has {len(weights)} trees, not {counts[-1]}")
    schema = T.StructType(
        [T.StructField("_tree", T.IntegerType()), T.StructField("_leaf", T.IntegerType()), T.StructField("_value", T.DoubleType())]
    )
    cells = [(t, leaf, value * weights[t]) for t, leaf, value in _leaf_values(booster.trees)]
    leaves = stored(spark.createDataFrame(cells, schema), "leaves")
    keyed = stored(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    placed = booster.transform(model.stages[0].transform(keyed)).select("_row", F.posexplode(vector_to_array("_leaves")).alias("_tree", "_leaf"))
    placed = placed.withColumn("_leaf", F.col("_leaf").cast("int"))
    sums = [F.sum(F.when(F.col("_tree") < n, F.col("_value"))).alias(f"_p{n}") for n in counts]
    path = placed.join(F.broadcast(leaves), ["_tree", "_leaf"]).groupBy("_row").agg(*sums)
    stages = F.array(*[F.struct(F.lit(n).alias("n_estimators"), F.col(f"_p{n}").alias(PREDICTION)) for n in counts])
    return keyed.join(path, "_row").select(*df.columns, F.inline(stages))


def parameter_sweep(
    train: DataFrame,
    test: DataFrame,
    n_estimators: Iterable[int] = SWEPT_TREES,
    max_depth: Iterable[int] = SWEPT_DEPTHS,
    base: dict | None = None,
    parallelism: int = 4,
) -> DataFrame:
    """Test metrics along two lines through the base parameters: tree counts, and depths.

    One fit with the most trees gives every tree count at the base depth; every other depth
    is a fit of its own with the base tree count. The split stays the given time split.
    """
    p = {**GBT_DEFAULTS, **(base or {})}
    counts, own = sorted(n_estimators), p["max_depth"]
    # Longest fits first, so that none of them is left to run alone.
    depths = sorted((d for d in max_depth if d != own), reverse=True)
    stages = sorted({*counts, p["n_estimators"]} if own in max_depth else {*counts})
    jobs = [lambda: fit_gbt(train, {**p, "n_estimators": max(stages)})]
    jobs += [lambda d=d: fit_gbt(train, {**p, "max_depth": d}) for d in depths]
    longest, *others = _together(jobs, parallelism)
    path = boosting_stages(longest, test, stages).withColumn("max_depth", F.lit(own))
    rows = [path]
    for depth, model in zip(depths, others):
        at = [F.lit(p["n_estimators"]).alias("n_estimators"), F.lit(depth).alias("max_depth")]
        rows.append(predict(model, test).select("*", *at))
    scored = stored(
        reduce(DataFrame.unionByName, [r.select("n_estimators", "max_depth", TARGET_COLUMN, PREDICTION) for r in rows]), "swept"
    )
    metrics = regression_metrics(scored, TARGET_COLUMN, PREDICTION, ["n_estimators", "max_depth"])
    return metrics.select("n_estimators", "max_depth", "rmse", "mae", "mape").orderBy("rmse")


def boosting_path(model: PipelineModel, test: DataFrame) -> list[float]:
    """Test rmse after each tree: the whole tree-count curve from one fitted model."""
    features = model.stages[0].transform(test)
    losses = model.stages[-1].evaluateEachIteration(features, "squared")
    return [loss**0.5 for loss in losses]


def learning_curve(
    train: DataFrame,
    test: DataFrame,
    fractions: Sequence[float] = (0.2, 0.4, 0.6, 0.8, 1.0),
    params: dict | None = None,
    parallelism: int = 5,
) -> DataFrame:
    """Train and test rmse for growing prefixes (oldest rows first) of the training set.

    All prefixes are marked in one pass; their fits run side by side.
    """
    n = train.count()
    sizes = [max(2, int(round(n * f, 6))) for f in fractions]
    marked = stored(train.withColumn("_segment", segment_of(cut_points(train, sizes))), "segments")
    prefixes = [marked.where(F.col("_segment") <= k).drop("_segment") for k in range(len(sizes))]
    models = _together([lambda x=x: fit_gbt(x, params) for x in prefixes], parallelism)
    rows = []
    for fraction, prefix, model in zip(fractions, prefixes, models):
        inside = regression_metrics(predict(model, prefix), TARGET_COLUMN, PREDICTION)
        outside = regression_metrics(predict(model, test), TARGET_COLUMN, PREDICTION)
        rows.append(
            inside.select(
                F.lit(float(fraction)).alias("fraction"),
                F.col("n_asins").alias("train_rows"),
                F.col("rmse").alias("train_rmse"),
            ).crossJoin(outside.select(F.col("rmse").alias("test_rmse")))
        )
    return reduce(DataFrame.unionByName, rows).orderBy("fraction")


def as_predictions(scored: DataFrame, version: str) -> DataFrame:
    """Scored gold rows in the layout of the predictions table, without the stamp."""
    diff = ratio(F.col(PREDICTION) - F.col("current_price"), F.col("current_price")) * 100
    return scored.select(
        "asin",
        "scrape_date",
        PREDICTION,
        "current_price",
        diff.alias("price_diff_pct"),
        F.lit(str(version)).alias("model_version"),
    )


def score(model: PipelineModel, gold: DataFrame, medians: DataFrame, version: str) -> DataFrame:
    """Predictions for gold rows, using the medians fitted with the model."""
    return as_predictions(predict(model, impute(engineered(gold), medians)), version)
