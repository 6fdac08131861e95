"""Daily run, modelling and monitoring jobs against stored tables."""

import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from quotemill.operators.gold import gold_from_silver, own_prices, rolling_features
from quotemill.operators.silver import competitor_map
from quotemill.plans import daily, modelling, monitoring
from quotemill.queries import binding as B
from quotemill.schemas import (
    BRONZE_PRODUCTS,
    GOLD_PRICE_FEATURES,
    GOLD_PRICE_PREDICTIONS,
    OPS_MODEL_VERSIONS,
    OPS_RUN_METRICS,
    OPS_RUN_PARAMETERS,
    SILVER_COMPETITOR_MAP,
    SILVER_PRICE_HISTORY,
)
from quotemill.sinks.tables import read_table, upsert_table

START = date(2024, 5, 1)
A, B_ = "B00000000A", "B00000000B"


def write_day(root, day, products, rivals):
    for kind, rows in (("products", products), ("competitors", rivals)):
        for name, content in rows.items():
            path = root / kind / day.isoformat() / f"{name}.json"
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(json.dumps(content))


def day_files(root, offset):
    day = START + timedelta(days=offset)
    at = f"{day.isoformat()}T10:00:00Z"
    products = {
        k: {"asin": k, "price": base + offset, "rating": 4.5, "stock": "In Stock", "currency": "USD", "scraped_at": at}
        for k, base in ((A, 100.0), (B_, 50.0))
    }
    rivals = {
        "A_competitors": [
            {"parent_asin": A, "asin": f"X{i}", "title": f"t{i}", "brand": "b", "price": p, "rating": 4.0, "currency": "USD", "fetched_at": at}
            for i, p in enumerate((80.0, 90.0, 120.0, 120.0))
        ],
        "B_competitors": [],
    }
    write_day(root, day, products, rivals)
    return day


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("jobs")
    snapshots, root = base / "snapshots", str(base / "warehouse")
    for offset in range(3):
        daily.run_day(spark, root, str(snapshots), day_files(snapshots, offset))
    return root, str(snapshots)


def test_gold_rows(spark, warehouse):
    rows = {(r.asin, r.scrape_date): r for r in read_table(spark, warehouse[0], GOLD_PRICE_FEATURES).collect()}
    assert len(rows) == 6
    last = rows[A, START + timedelta(days=2)]
    assert (last.current_price, last.price_7d_ma, last.comp_count, last.competitors_below) == (102.0, 101.0, 4, 2)
    assert last.comp_median_price == 90.0 and last.suggested_price == 92.7
    assert last.price_position == "above_market" and last.comp_pressure_score == 0.5
    alone = rows[B_, START]
    assert alone.comp_count is None and alone.suggested_price is None and alone.price_7d_volatility is None


def test_map_rows(spark, warehouse):
    rows = read_table(spark, warehouse[0], SILVER_COMPETITOR_MAP).where(F.col("scrape_date") == F.lit(START))
    assert sorted((r.asin, r.price_rank, r.title) for r in rows.collect()) == [
        ("X0", 1, "t0"), ("X1", 2, "t1"), ("X2", 3, "t2"), ("X3", 3, "t3"),
    ]


def test_rerun_changes_nothing_downstream(spark, warehouse):
    root, snapshots = warehouse

    def counts():
        return [read_table(spark, root, t).count() for t in (SILVER_PRICE_HISTORY, SILVER_COMPETITOR_MAP, GOLD_PRICE_FEATURES)]

    before, bronze = counts(), read_table(spark, root, BRONZE_PRODUCTS).count()
    daily.run_day(spark, root, snapshots, START)
    assert counts() == before
    assert read_table(spark, root, BRONZE_PRODUCTS).count() == bronze + 2
    loaded = daily.load_bronze(spark, root, snapshots, START, once=True)
    assert loaded.skipped == ["bronze.products", "bronze.competitors"]
    assert read_table(spark, root, BRONZE_PRODUCTS).count() == bronze + 2


def test_missing_day_is_skipped(spark, warehouse):
    root, snapshots = warehouse
    result = daily.load_bronze(spark, root, snapshots, "1999-01-01")
    assert result.skipped == ["bronze.products", "bronze.competitors"] and not result.loads


def test_checks_pass(spark, warehouse):
    assert daily.check_layers(spark, warehouse[0], only_failures=True).isEmpty()


def test_tails_carry_the_history(spark, sf, tmp_path):
    """Daily runs from tails equal one pass over everything, also after a correction."""
    root = str(tmp_path)
    history = B.stored_history(spark, sf)
    days = [f"2024-01-{d:02d}" for d in range(1, 13)]

    def load(day, price=None):
        rows = history.where(f"scrape_date = DATE '{day}'")
        if price:
            rows = rows.withColumn("price", F.lit(price))
        upsert_table(rows, SILVER_PRICE_HISTORY, root, day)

    def gold_of(day):
        daily.build_gold(spark, root, day)
        rows = read_table(spark, root, GOLD_PRICE_FEATURES).where(f"scrape_date = DATE '{day}'")
        return sorted(map(repr, rows.select(columns).collect()))

    columns = [c for c in GOLD_PRICE_FEATURES.schema.fieldNames() if c != "_computed_at"]

    def full(day):
        stored = read_table(spark, root, SILVER_PRICE_HISTORY)
        market = read_table(spark, root, SILVER_COMPETITOR_MAP)
        features = gold_from_silver(stored, market).where(f"scrape_date = DATE '{day}'")
        return sorted(map(repr, features.select(columns).collect()))

    for day in days[:10]:
        load(day)
    gold_of(days[8])
    assert daily.last_valid_tails(spark, root, date.fromisoformat(days[9])) == date.fromisoformat(days[8])
    assert gold_of(days[9]) == full(days[9])
    load(days[10])
    assert daily.last_valid_tails(spark, root, date.fromisoformat(days[10])) == date.fromisoformat(days[9])
    load(days[7], price=77.0)  # correcting an old day makes every stored tail stale
    assert daily.last_valid_tails(spark, root, date.fromisoformat(days[10])) is None
    assert gold_of(days[10]) == full(days[10])
    load(days[11])
    assert daily.last_valid_tails(spark, root, date.fromisoformat(days[11])) == date.fromisoformat(days[10])
    assert gold_of(days[11]) == full(days[11])


def test_day_by_day_equals_backfill(spark, sf):
    history = B.stored_history(spark, sf)
    market = competitor_map(history)
    backfill = gold_from_silver(history, market)
    for day in ("2024-01-01", "2024-01-04", "2024-01-15", "2024-01-30"):
        wanted = sorted(map(tuple, backfill.where(f"scrape_date = DATE '{day}'").collect()))
        got = sorted(map(tuple, gold_from_silver(history, market, as_of=day).collect()))
        assert len(got) == len(wanted) > 0
        for a, b in zip(got, wanted):
            assert a == pytest.approx(b, nan_ok=True) if all(isinstance(x, float) for x in a) else repr(a) == repr(b)


def test_single_history_row(spark):
    rows = spark.createDataFrame([("A", START, 5.0, None, "USD", "in_stock")],
                                 "asin string, scrape_date date, price double, rating double, currency string, stock string")
    row = rolling_features(rows).first()
    assert (row.price_7d_ma, row.price_7d_volatility, row.price_momentum) == (5.0, None, None)


@pytest.fixture(scope="module")
def modelled(spark, sf, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("models"))
    upsert_table(B.stored_gold(spark, sf), GOLD_PRICE_FEATURES, root)
    result = modelling.train(spark, root, {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.5})
    return root, result


def test_training(spark, modelled):
    root, result = modelled
    assert result["version"] == 1 and result["rmse"] > 0
    assert len(result["importances"]) == 13 and sum(result["importances"].values()) == pytest.approx(1.0)
    assert read_table(spark, root, OPS_RUN_METRICS).where("metric = 'rmse'").count() == 1
    logged = {r.parameter: r.value for r in read_table(spark, root, OPS_RUN_PARAMETERS).where("run = 'train_v1'").collect()}
    assert logged["test_size"] == "0.2" and logged["max_depth"]


def test_gate_promote_score_monitor(spark, modelled):
    root, _ = modelled
    with pytest.raises(ValueError, match="Quality gate FAILED"):
        modelling.evaluate(spark, root, max_rmse=0.0)
    with pytest.raises(ValueError, match="No model versions"):
        modelling.score_day(spark, root, B.DAY)
    verdict = modelling.evaluate(spark, root, max_rmse=None, max_mape=None)
    assert verdict["passed"] and len(verdict["worst"]) == 5
    audit = modelling.score_day(spark, root, B.DAY)
    gold = read_table(spark, root, GOLD_PRICE_FEATURES).where(f"scrape_date = DATE '{B.DAY}'")
    assert audit["inserted"] == gold.count() > 0
    assert modelling.score_day(spark, root, B.DAY)["inserted"] == 0
    predictions = read_table(spark, root, GOLD_PRICE_PREDICTIONS)
    assert predictions.where("predicted_price IS NULL OR model_version <> '1'").isEmpty()
    alert = monitoring.monitor_performance(spark, root, B.DAY)
    assert alert["days"] == 1 and alert["status"] in ("healthy", "degraded")
    assert monitoring.monitor_performance(spark, root, "1999-01-01")["status"].startswith("skipped")
    assert monitoring.monitor_drift(spark, root, "1999-01-01")["status"].startswith("skipped")
    drift = monitoring.monitor_drift(spark, root, B.DAY)
    assert drift["status"] in ("drift detected", "no drift", "skipped — insufficient data")


def test_promotion_archives_the_old_version(spark, modelled):
    root, _ = modelled
    modelling.train(spark, root, {"n_estimators": 2, "max_depth": 2})
    modelling.promote(spark, root, 2)
    stages = {r.version: r.stage for r in modelling._versions(spark, root).collect()}
    assert stages == {1: "Archived", 2: "Production"}
    assert read_table(spark, root, OPS_MODEL_VERSIONS).count() >= 4
