"""Append, upsert, audit and table declarations."""

import pytest
from pyspark.sql import functions as F

from quotemill.operators.merge import duplicate_keys, merge_rows
from quotemill.operators.quality import missing_columns, quality_report
from quotemill.operators.serving import current_competitors, current_products, fetch_worklist
from quotemill.queries import binding as B
from quotemill.schemas import (
    GOLD_PRICE_FEATURES,
    GOLD_PRICE_PREDICTIONS,
    OPS_LOAD_AUDIT,
    SILVER_PRICE_HISTORY,
    TABLES,
    create_tables,
)
from quotemill.sinks.tables import conform, log_metrics, read_table, upsert_table

KEYS = SILVER_PRICE_HISTORY.keys


def plain(df):
    return sorted(map(tuple, df.drop("_updated_at", "scraped_at").collect()), key=repr)


@pytest.fixture(scope="module")
def history(spark, sf):
    return B.stored_history(spark, sf)


def test_upsert_twice_equals_once(spark, history, tmp_path):
    root = str(tmp_path)
    upsert_table(history, SILVER_PRICE_HISTORY, root, "a")
    once = plain(read_table(spark, root, SILVER_PRICE_HISTORY))
    audit = upsert_table(history, SILVER_PRICE_HISTORY, root, "b")
    assert plain(read_table(spark, root, SILVER_PRICE_HISTORY)) == once == plain(conform(history, SILVER_PRICE_HISTORY))
    n = history.count()
    assert (audit["rows_in"], audit["inserted"], audit["updated"]) == (n, 0, n)
    assert read_table(spark, root, OPS_LOAD_AUDIT).count() == 2


def test_upsert_leaves_other_days_alone(spark, history, tmp_path):
    root = str(tmp_path)
    upsert_table(history, SILVER_PRICE_HISTORY, root)
    day = "scrape_date = DATE '2024-01-05'"
    before = plain(read_table(spark, root, SILVER_PRICE_HISTORY).where(f"NOT ({day})"))
    changed = history.where(day).withColumn("price", F.lit(1.5))
    upsert_table(changed, SILVER_PRICE_HISTORY, root)
    after = read_table(spark, root, SILVER_PRICE_HISTORY)
    assert plain(after.where(f"NOT ({day})")) == before
    assert {r.price for r in after.where(day).collect()} == {1.5}


def test_upsert_keeps_columns_not_updated(spark, history, tmp_path):
    root = str(tmp_path)
    upsert_table(history, SILVER_PRICE_HISTORY, root)
    changed = history.withColumns({"price": F.lit(2.0), "stock": F.lit("changed")})
    upsert_table(changed, SILVER_PRICE_HISTORY, root, update_columns=["price"])
    rows = read_table(spark, root, SILVER_PRICE_HISTORY)
    assert rows.where("price <> 2.0 OR stock = 'changed'").count() == 0


def test_repeated_source_keys_raise_before_writing(spark, history, tmp_path):
    with pytest.raises(ValueError, match="repeat a key"):
        upsert_table(history.unionByName(history), SILVER_PRICE_HISTORY, str(tmp_path))
    assert read_table(spark, str(tmp_path), SILVER_PRICE_HISTORY).isEmpty()


def test_empty_source_is_audited(spark, history, tmp_path):
    audit = upsert_table(history.where("false"), SILVER_PRICE_HISTORY, str(tmp_path))
    assert audit["rows_in"] == 0


def test_merge_matches_null_keys(spark):
    target = spark.createDataFrame([("a", None, 1.0), ("b", "p", 2.0)], "k string, parent string, v double")
    source = spark.createDataFrame([("a", None, 9.0), ("b", None, 3.0)], "k string, parent string, v double")
    got = sorted(map(tuple, merge_rows(target, source, ["k", "parent"]).collect()), key=repr)
    assert got == sorted([("a", None, 9.0), ("b", "p", 2.0), ("b", None, 3.0)], key=repr)


def test_silver_keys_are_unique(history):
    assert duplicate_keys(history, KEYS).isEmpty()


def test_current_products(spark):
    data = [("A", "t1", 10.0, 1), ("A", None, 12.0, 2), (None, "x", 1.0, 3), ("", "x", 1.0, 3)]
    rows = current_products(spark.createDataFrame(data, "asin string, title string, price double, scraped_at int"))
    assert list(map(tuple, rows.collect())) == [("A", None, 12.0, 2)]


def test_current_competitors(spark):
    rivals = spark.createDataFrame(
        [("P", "x", 1), ("P", "y", 1), ("P", "x", 2), ("P", None, 2), ("Q", "z", 1), ("R", "w", 1)],
        "parent_asin string, asin string, fetched_at int",
    )
    log = spark.createDataFrame(
        [("P", 1), ("P", 2), ("Q", 1), ("R", 1), ("R", 2)], "parent_asin string, fetched_at int"
    )
    rows = current_competitors(rivals, log)
    # P was refetched with one keyed item, Q is untouched, R's last fetch found nothing.
    assert sorted((r.parent_asin, r.asin) for r in rows.collect()) == [("P", "x"), ("Q", "z")]
    manifest = spark.createDataFrame([("P",), ("S",)], "asin string")
    assert [r.asin for r in fetch_worklist(manifest, rows).collect()] == ["S"]


def test_ddl(spark):
    found = create_tables(spark)
    assert set(found) >= {t.full_name for t in TABLES}
    for table in TABLES:
        stored = spark.table(table.full_name)
        assert set(stored.columns) == set(table.schema.fieldNames())
        if table.partition:
            described = spark.sql(f"DESCRIBE TABLE {table.full_name}").collect()
            assert "# Partition Information" in {r.col_name for r in described}


def test_gold_and_prediction_schemas(spark, sf):
    gold = B.stored_gold(spark, sf)
    assert missing_columns(gold, [c for c in GOLD_PRICE_FEATURES.schema.fieldNames() if not c.startswith("_")]) == []
    assert duplicate_keys(gold, GOLD_PRICE_FEATURES.keys).isEmpty()
    assert gold.where("comp_pressure_score NOT BETWEEN 0 AND 1").isEmpty()
    predictions = B.predictions(spark, sf)
    wanted = [c for c in GOLD_PRICE_PREDICTIONS.schema.fieldNames() if c != "scored_at"]
    assert missing_columns(predictions, wanted) == [] and not predictions.isEmpty()


def test_quality_report_finds_planted_errors(spark):
    bad = spark.createDataFrame(
        [("A", "2024-01-01", 1.7, "sideways"), ("A", "2024-01-01", 0.5, "at_market"), ("B", "2024-01-01", None, None)],
        "asin string, scrape_date string, comp_pressure_score double, price_position string",
    )
    report = {r.check_name: r.failing_rows for r in quality_report({"gold.price_features": bad}).collect()}
    assert report == {
        "comp_pressure_score out of range": 1,
        "invalid price_position": 1,
        "duplicate (asin, scrape_date)": 1,
    }
    clean = bad.where("asin = 'B'")
    assert quality_report({"gold.price_features": clean}, only_failures=True).isEmpty()


def test_run_metrics(spark, tmp_path):
    from quotemill.schemas import OPS_RUN_METRICS

    log_metrics(spark, str(tmp_path), "r1", {"rmse": 1.0, "mape": None})
    rows = read_table(spark, str(tmp_path), OPS_RUN_METRICS).collect()
    assert {(r.metric, r.value) for r in rows} == {("rmse", 1.0), ("mape", None)}
