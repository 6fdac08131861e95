"""Current state and the per-product analysis record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pricing
from ..functions.text import normalise_key, stock_signal
from ..rules import HOT_GROUP_ROWS, RULES, PriceRules
from .ordered import exact_percentiles, latest_per
from .silver import DEFAULT_CURRENCY


def _has_key(name: str):
    return F.col(name).isNotNull() & (F.col(name) != "")


def current_products(bronze: DataFrame) -> DataFrame:
    """Last snapshot of each product; every field, nulls included, is the last one's."""
    ties = [c for c in ("price", "rating", "stock", "currency") if c in bronze.columns]
    return latest_per(bronze.where(_has_key("asin")), ["asin"], "scraped_at", ties)


def current_competitors(bronze: DataFrame, fetch_log: DataFrame) -> DataFrame:
    """Competitors found by the last fetch of each parent.

    ``fetch_log`` (parent_asin, fetched_at) also lists fetches that found nothing; a
    parent whose last fetch was empty has no rows here.
    """
    last = fetch_log.groupBy("parent_asin").agg(F.max("fetched_at").alias("fetched_at"))
    return bronze.where(_has_key("asin")).join(last, ["parent_asin", "fetched_at"], "left_semi")


def competitors_of(competitors: DataFrame, parent: str) -> DataFrame:
    return competitors.where(F.col("parent_asin") == normalise_key(F.lit(parent)))


def fetch_worklist(manifest: DataFrame, cached: DataFrame) -> DataFrame:
    """Tracked keys that have no cached competitor rows yet."""
    known = cached.select(F.col("parent_asin").alias("asin"))
    return manifest.join(known, "asin", "left_anti")


def _market(competitors: DataFrame, hot_rows: int) -> DataFrame:
    """Unrounded market figures per parent; parents without any price are dropped."""
    return exact_percentiles(
        competitors,
        ["parent_asin"],
        "price",
        {"_median": 0.5},
        [
            F.avg("price").alias("_avg"),
            F.min("price").alias("_min"),
            F.max("price").alias("_max"),
            F.count("price").alias("_count"),
            F.avg("rating").alias("_rating"),
        ],
        hot_rows,
    ).where("_count > 0")


def _stats():
    return F.struct(
        pricing.money(F.col("_median")).alias("median"),
        pricing.money(F.col("_avg")).alias("avg"),
        pricing.money(F.col("_min")).alias("min"),
        pricing.money(F.col("_max")).alias("max"),
        F.col("_count").cast("int").alias("count"),
    )


def serving_price_stats(competitors: DataFrame, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """Exact median, mean, range and count of priced competitors per parent."""
    return _market(competitors, hot_rows).select("parent_asin", _stats().alias("s")).select(
        "parent_asin", "s.*"
    )


def serving_analysis(
    products: DataFrame,
    competitors: DataFrame,
    rules: PriceRules = RULES,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Analysis record of every product: statistics, suggestion and stock signal."""
    market = _market(competitors, hot_rows).withColumnRenamed("parent_asin", "asin")
    price = F.col("price")
    median = pricing.money(F.col("_median"))
    premium = pricing.rating_premium(F.col("rating"), F.col("_rating"), rules)
    suggested = pricing.suggested_price(median, premium)
    suggestion = F.struct(
        suggested.alias("suggested_price"),
        pricing.discount_pct(price, suggested).alias("discount_pct"),
        pricing.price_position(price, median, rules.position_band).alias("price_position"),
    )
    priced = F.col("_count").isNotNull()
    return products.join(market, "asin", "left").select(
        "asin",
        "title",
        price.alias("current_price"),
        F.coalesce(F.nullif("currency", F.lit("")), F.lit(DEFAULT_CURRENCY)).alias("currency"),
        F.when(priced, _stats()).alias("price_stats"),
        F.when(priced & price.isNotNull(), suggestion).alias("suggestion"),
        stock_signal(F.col("stock")).alias("stock_signal"),
    )
