"""The given tables seen as price snapshots.

Every event is one snapshot. Users divisible by ten are own products, the other nine of
each decade are their competitors. A few prices, ratings and currencies are blanked by
rule so that cleaning has something to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.gold import gold_from_silver, own_prices
from ..operators.models import as_predictions, naive_baseline
from ..operators.silver import competitor_map, silver_price_history
from ..session import stored

# Last day of the given event stream.
DAY = "2024-01-30"

SNAPSHOT = {
    "asin": "'B' || lpad(CAST(user_id AS STRING), 9, '0')",
    "parent_asin": "'B' || lpad(CAST(user_id - user_id % 10 AS STRING), 9, '0')",
    "title": "'Item ' || CAST(user_id AS STRING) || ' - ' || event_type",
    "brand": "'Brand ' || CAST(user_id % 7 AS STRING)",
    "price": (
        "CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN CAST(0 AS DOUBLE) "
        "ELSE value END"
    ),
    "currency": "CASE WHEN event_id % 53 = 0 THEN NULL ELSE 'USD' END",
    "rating": (
        "CASE WHEN event_id % 31 = 0 THEN NULL "
        "ELSE CAST(3 AS DOUBLE) + CAST(event_id % 21 AS DOUBLE) / CAST(10 AS DOUBLE) END"
    ),
    "stock": (
        "CASE event_type WHEN 'view' THEN 'In Stock' WHEN 'click' THEN 'Only 3 left in stock' "
        "WHEN 'purchase' THEN 'Usually available in 2 days' "
        "WHEN 'signup' THEN 'Currently unavailable' ELSE 'Out of Stock' END"
    ),
    "seen_at": "ts",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bronze_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = SNAPSHOT
    return table(spark, sf_dir, "events").where("user_id % 10 = 0").selectExpr(
        *[f"{s[c]} AS {c}" for c in ("asin", "title", "brand", "price", "currency", "stock", "rating")],
        "ts AS scraped_at",
    )


def bronze_competitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = SNAPSHOT
    return table(spark, sf_dir, "events").where("user_id % 10 <> 0").selectExpr(
        *[f"{s[c]} AS {c}" for c in ("parent_asin", "asin", "title", "brand", "price", "currency", "rating")],
        "ts AS fetched_at",
    )


def price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_price_history(bronze_products(spark, sf_dir), bronze_competitors(spark, sf_dir))


def own_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return own_prices(price_history(spark, sf_dir))


def stored_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table as the daily job leaves it: written once, read by what follows."""
    return stored(price_history(spark, sf_dir), "price_history")


def rivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return competitor_map(stored_history(spark, sf_dir))


def stored_rivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(rivals(spark, sf_dir), "competitor_map")


def gold(spark: SparkSession, sf_dir: str, exact: bool = False) -> DataFrame:
    history = stored_history(spark, sf_dir)
    market = competitor_map(history)
    if exact:
        market = stored(market, "competitor_map")
    return gold_from_silver(history, market, exact=exact)


def stored_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(gold(spark, sf_dir), "price_features")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of the naive model for every gold row that has a market."""
    rows = stored_gold(spark, sf_dir).where(F.col("comp_median_price").isNotNull())
    return as_predictions(naive_baseline(rows), "naive")


def fetches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(competitor rows, fetch log): one fetch per parent and day.

    Each day with a snapshot of the parent counts as a fetch, so some fetches are empty.
    """
    day = "CAST(ts AS DATE)"
    rows = bronze_competitors(spark, sf_dir).withColumn("fetched_at", F.to_date("fetched_at"))
    log = (
        table(spark, sf_dir, "events")
        .selectExpr(f"{SNAPSHOT['parent_asin']} AS parent_asin", f"{day} AS fetched_at")
        .distinct()
    )
    return rows, log
