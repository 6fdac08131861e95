"""Event-time operators; each works on a streaming and on a batch DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _with_watermark(df: DataFrame, time: str, lateness: str) -> DataFrame:
    return df.withWatermark(time, lateness) if df.isStreaming else df


def first_per_snapshot(df: DataFrame, keys: list[str], time: str, lateness: str = "1 hour") -> DataFrame:
    """Drop repeated snapshots that arrive within ``lateness`` of each other."""
    if df.isStreaming:
        return df.withWatermark(time, lateness).dropDuplicatesWithinWatermark(keys)
    return df.dropDuplicates(keys)


def _statistics():
    return [
        F.count(F.lit(1)).alias("rows"),
        F.avg("price").alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
    ]


def price_windows(
    df: DataFrame,
    time: str = "scraped_at",
    size: str = "1 day",
    slide: str | None = None,
    keys: tuple[str, ...] = ("asin",),
    lateness: str = "1 hour",
) -> DataFrame:
    """Price statistics per key and tumbling window, or sliding window with ``slide``."""
    window = F.window(time, size, slide) if slide else F.window(time, size)
    grouped = _with_watermark(df, time, lateness).groupBy(window.alias("w"), *keys)
    return grouped.agg(*_statistics()).select(
        *keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"),
        "rows", "avg_price", "min_price", "max_price",
    )


def price_sessions(
    df: DataFrame,
    time: str = "scraped_at",
    gap: str = "6 hours",
    keys: tuple[str, ...] = ("asin",),
    lateness: str = "1 hour",
) -> DataFrame:
    """Price statistics per key and session: snapshots closer together than ``gap``."""
    grouped = _with_watermark(df, time, lateness).groupBy(F.session_window(time, gap).alias("w"), *keys)
    return grouped.agg(*_statistics()).select(
        *keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"),
        "rows", "avg_price", "min_price", "max_price",
    )
