"""Model queries. Trees and forests have no SQL twin; the row sets are checked in tests."""

from __future__ import annotations

from ..operators import models as L
from ..plans import modelling as M
from ..plans.modelling import prepare
from ..schemas import GOLD_PRICE_FEATURES, GOLD_PRICE_PREDICTIONS
from ..session import scratch_path
from ..sinks.tables import read_table, upsert_table
from . import binding as B
from .registry import query

def _split(spark, sf):
    return prepare(B.stored_gold(spark, sf))


@query("gbt_predictions")
def gbt_predictions(spark, sf):
    gold = B.stored_gold(spark, sf)
    split = prepare(gold)
    return L.score(L.fit_gbt(split.train), gold, split.medians, "1")


@query("gbt_feature_importances")
def gbt_feature_importances(spark, sf):
    return L.importances(L.fit_gbt(_split(spark, sf).train))


@query("model_leaderboard")
def model_leaderboard(spark, sf):
    split = _split(spark, sf)
    return L.compare_models(split.train, split.test)


@query("parameter_sweep")
def parameter_sweep(spark, sf):
    split = _split(spark, sf)
    return L.parameter_sweep(split.train, split.test)


@query("learning_curve")
def learning_curve(spark, sf):
    split = _split(spark, sf)
    return L.learning_curve(split.train, split.test)


@query("model_lifecycle")
def model_lifecycle(spark, sf):
    """Train, gate, promote and score against stored tables; returns the stored predictions."""
    root = scratch_path(spark, "warehouse")
    upsert_table(B.gold(spark, sf), GOLD_PRICE_FEATURES, root)
    M.train(spark, root)
    M.evaluate(spark, root)
    M.score_day(spark, root, B.DAY)
    return read_table(spark, root, GOLD_PRICE_PREDICTIONS).drop("scored_at")
