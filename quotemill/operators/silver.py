"""Cleaning, daily deduplication and the ranked competitor map."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.binning import as_day, within_day
from ..functions.pricing import pct_of
from ..functions.text import stock_level
from ..rules import HOT_GROUP_ROWS, STOCK_RULES, StockRule
from .ordered import latest_per, rank_rows, rank_rows_distributed, split_hot

DEFAULT_CURRENCY = "USD"
_TIES = ("price", "rating", "currency", "stock")


def clean_products(
    bronze: DataFrame,
    day: str | date | None = None,
    stock_rules: Sequence[StockRule] = STOCK_RULES,
) -> DataFrame:
    """Own products: priced rows only, the last snapshot per (asin, day)."""
    rows = bronze.where(F.col("asin").isNotNull() & (F.col("price") > 0))
    if day is not None:
        rows = rows.where(within_day(F.col("scraped_at"), day))
    cleaned = rows.select(
        "asin",
        F.col("price").cast("double").alias("price"),
        F.coalesce("currency", F.lit(DEFAULT_CURRENCY)).alias("currency"),
        stock_level(F.col("stock"), stock_rules).alias("stock"),
        F.col("rating").cast("double").alias("rating"),
        F.lit("product").alias("source"),
        F.lit(None).cast("string").alias("parent_asin"),
        F.to_date("scraped_at").alias("scrape_date"),
        "scraped_at",
    )
    return latest_per(cleaned, ["asin", "scrape_date"], "scraped_at", _TIES)


def clean_competitors(
    bronze: DataFrame, day: str | date | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """Competitors: priced rows only, the last fetch per (asin, parent, day)."""
    rows = bronze.where(
        F.col("asin").isNotNull() & F.col("parent_asin").isNotNull() & (F.col("price") > 0)
    )
    if day is not None:
        rows = rows.where(within_day(F.col("fetched_at"), day))
    cleaned = rows.select(
        "asin",
        F.col("price").cast("double").alias("price"),
        F.coalesce("currency", F.lit(DEFAULT_CURRENCY)).alias("currency"),
        F.lit("unknown").alias("stock"),
        F.col("rating").cast("double").alias("rating"),
        F.lit("competitor").alias("source"),
        "parent_asin",
        F.to_date("fetched_at").alias("scrape_date"),
        F.col("fetched_at").alias("scraped_at"),
        *carry,
    )
    return latest_per(cleaned, ["asin", "parent_asin", "scrape_date"], "scraped_at", (*_TIES, *carry))


def silver_price_history(
    products: DataFrame,
    competitors: DataFrame,
    day: str | date | None = None,
    stock_rules: Sequence[StockRule] = STOCK_RULES,
) -> DataFrame:
    """Union of both sources, one row per (asin, day, source, parent)."""
    return clean_products(products, day, stock_rules).unionByName(clean_competitors(competitors, day))


def competitor_map(
    price_history: DataFrame,
    day: str | date | None = None,
    descriptions: DataFrame | None = None,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Competitors of each (parent, day) with price difference and price rank.

    Ranking and the lookup of the parent's own price share one exchange on
    (parent, day). A parent with more than ``hot_rows`` competitors on one day is ranked
    by the distributed plan, so it never lands in one task.
    ``descriptions`` optionally adds title and brand on (parent_asin, asin, scrape_date).
    """
    rows = price_history
    if day is not None:
        rows = rows.where(F.col("scrape_date") == F.lit(as_day(day)))
    own = rows.where("source = 'product'").select(
        F.col("asin").alias("parent_asin"), "scrape_date", F.col("price").alias("_own")
    )
    rivals = rows.where("source = 'competitor'").select(
        "parent_asin", "asin", "price", "currency", "rating", "scrape_date"
    )
    keys = ["parent_asin", "scrape_date"]
    split = split_hot(rivals, keys, hot_rows)
    ranked = rank_rows(split.ordinary, keys, "price", "price_rank").join(own, keys, "left")
    if split.hot is not None:
        hot_own = own.join(split.keys, keys, "left_semi")
        hot_ranked = rank_rows_distributed(split.hot, keys, "price", "price_rank")
        ranked = ranked.unionByName(hot_ranked.join(split.small(hot_own), keys, "left"))
    if descriptions is not None:
        ranked = ranked.join(
            descriptions.select("parent_asin", "asin", "scrape_date", "title", "brand"),
            ["parent_asin", "asin", "scrape_date"],
            "left",
        )
    else:
        empty = F.lit(None).cast("string")
        ranked = ranked.withColumns({"title": empty, "brand": empty})
    return ranked.select(
        "parent_asin",
        "asin",
        "title",
        "brand",
        "price",
        "currency",
        "rating",
        pct_of(F.col("price") - F.col("_own"), F.col("_own")).alias("price_diff_pct"),
        "price_rank",
        "scrape_date",
    )
