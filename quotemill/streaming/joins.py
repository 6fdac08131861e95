"""Joins of two event-time streams; each works on streaming and on batch DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.pricing import ratio
from .windows import _with_watermark


def competitor_prices(
    products: DataFrame,
    competitors: DataFrame,
    within: str = "1 day",
    lateness: str = "1 hour",
) -> DataFrame:
    """Competitor prices beside the own prices seen up to ``within`` before them.

    ``products`` has ``asin, price, scraped_at``, ``competitors`` ``parent_asin, asin, price,
    fetched_at``. On streams both sides are watermarked by ``lateness``, and the range bounds
    what a side has to remember: a product row is dropped from the state once the
    competitors' watermark is ``within`` past it, a competitor row once the products'
    watermark has reached it. Rows later than ``lateness`` may find their partners gone.
    Rows without key, time or price have no partner.
    """
    own = _with_watermark(products, "scraped_at", lateness).select(
        F.col("asin").alias("_own"), F.col("price").alias("own_price"), "scraped_at"
    )
    rivals = _with_watermark(competitors, "fetched_at", lateness).select("parent_asin", "asin", "price", "fetched_at")
    near = F.expr(f"scraped_at <= fetched_at AND scraped_at > fetched_at - INTERVAL {within}")
    joined = rivals.join(own, (F.col("parent_asin") == F.col("_own")) & near)
    difference = ratio((F.col("price") - F.col("own_price")) * 100, F.col("own_price"))
    return joined.where("price IS NOT NULL AND own_price IS NOT NULL").select(
        "parent_asin", "asin", "fetched_at", "scraped_at", "price", "own_price", difference.alias("price_diff_pct")
    )
