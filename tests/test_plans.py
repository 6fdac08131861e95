"""Physical plans: what must and must not be in them."""

import pytest

from quotemill.operators.gold import competitor_landscape, gold_from_silver, own_prices, rolling_features
from quotemill.operators.silver import clean_products, competitor_map
from quotemill.queries import binding as B
from quotemill.schemas import SILVER_COMPETITOR_MAP, SILVER_PRICE_HISTORY
from quotemill.sinks.bucketed import KEY, create_bucketed, key_digest, merged_buckets, upsert_bucketed
from quotemill.sinks.tables import conform, read_table, upsert_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, sf, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    history = B.stored_history(spark, sf)
    upsert_table(history, SILVER_PRICE_HISTORY, root)
    upsert_table(competitor_map(history), SILVER_COMPETITOR_MAP, root)
    return read_table(spark, root, SILVER_PRICE_HISTORY), read_table(spark, root, SILVER_COMPETITOR_MAP)


def test_no_python_in_the_gold_plan(tables):
    text = plan(gold_from_silver(*tables))
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_day_prunes_partitions(tables):
    text = plan(gold_from_silver(*tables, as_of=B.DAY))
    assert f"(scrape_date#" in text and text.count("PartitionFilters: [isnotnull(scrape_date") >= 2


def test_latest_row_is_limited_before_the_shuffle(spark, sf):
    text = plan(clean_products(B.bronze_products(spark, sf)))
    assert text.count("WindowGroupLimit") == 2
    assert text.count("Exchange hashpartitioning") == 1


def test_landscape_needs_one_exchange_and_no_join(tables):
    text = plan(competitor_landscape(tables[1]))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_rank_and_own_price_share_the_exchange(tables):
    text = plan(competitor_map(tables[0]))
    # one exchange for the competitors, at most one for the own prices
    assert text.count("Exchange hashpartitioning") <= 2


def test_scan_reads_only_needed_columns(tables):
    text = plan(competitor_landscape(tables[1]).select("asin", "comp_min_price"))
    assert "ReadSchema: struct<parent_asin:string,price:double>" in text


def test_rolling_uses_one_exchange(tables):
    assert plan(rolling_features(own_prices(tables[0]))).count("Exchange hashpartitioning") == 1


def test_price_filter_reaches_the_scan(tables):
    text = plan(own_prices(tables[0]).where("price > 50"))
    assert "GreaterThan(price,50.0)" in text and "EqualTo(source,product)" in text


@pytest.fixture(scope="module")
def bucketed(spark, sf, tmp_path_factory):
    history = B.stored_history(spark, sf)
    create_bucketed(spark, SILVER_PRICE_HISTORY, "plan_buckets", 4, str(tmp_path_factory.mktemp("buckets")))
    upsert_bucketed(history, SILVER_PRICE_HISTORY, "plan_buckets")
    yield history
    spark.sql("DROP TABLE plan_buckets")


def test_bucketed_merge_leaves_the_stored_side_in_place(spark, bucketed):
    """No exchange above the target's scan: only the staged rows are shuffled."""
    staged = conform(bucketed, SILVER_PRICE_HISTORY).withColumn(KEY, key_digest(SILVER_PRICE_HISTORY.keys))
    merged = merged_buckets(staged, SILVER_PRICE_HISTORY, "plan_buckets", [d[0] for d in bucketed.select("scrape_date").distinct().collect()])
    text = plan(merged)
    assert "Bucketed: true" in text
    assert text.count("Exchange hashpartitioning") == 1
    exchange = text.index("Exchange hashpartitioning")
    scan = text.index("Bucketed: true")
    assert scan < exchange or "plan_buckets" not in text[exchange:].split("Scan", 2)[1]
    assert merged.where(f"{KEY} IS NULL").isEmpty()


def test_bucketed_files_are_one_per_bucket_and_day(spark, bucketed):
    upsert_bucketed(bucketed, SILVER_PRICE_HISTORY, "plan_buckets")
    rows = spark.table("plan_buckets")
    assert rows.count() == bucketed.count()
    files = rows.select("_metadata.file_path").distinct().count()
    assert files <= 4 * rows.select("scrape_date").distinct().count()
    with pytest.raises(ValueError, match="repeat a key"):
        upsert_bucketed(bucketed.unionByName(bucketed), SILVER_PRICE_HISTORY, "plan_buckets")
