"""Rolling price features, competitor landscape and the gold feature row."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import pricing
from ..functions.binning import as_day
from ..rules import HOT_GROUP_ROWS, RULES, PriceRules
from .ordered import exact_percentiles, last_rows_per


def own_prices(price_history: DataFrame) -> DataFrame:
    return price_history.where("source = 'product'").select(
        "asin", "scrape_date", "price", "rating", "currency", "stock"
    )


def rolling_features(
    history: DataFrame,
    window: int = RULES.window_rows,
    lag: int = RULES.lag_rows,
    as_of: str | date | None = None,
) -> DataFrame:
    """Moving average, sample deviation and momentum over the last rows of each product.

    ``history`` has one row per (asin, scrape_date), so a window partition never holds
    more rows than there are days. With ``as_of`` only that day's rows are returned, and
    only the rows its frames can reach are shuffled.
    """
    rows = history
    if as_of is not None:
        rows = rows.where(F.col("scrape_date") <= F.lit(as_day(as_of)))
        rows = last_rows_per(rows, ["asin"], "scrape_date", max(window, lag + 1))
    timeline = Window.partitionBy("asin").orderBy("scrape_date")
    frame = timeline.rowsBetween(1 - window, 0)
    out = rows.select(
        "*",
        F.avg("price").over(frame).alias("price_7d_ma"),
        F.stddev("price").over(frame).alias("price_7d_volatility"),
        pricing.momentum(F.col("price"), F.lag("price", lag).over(timeline)).alias("price_momentum"),
    )
    if as_of is not None:
        out = out.where(F.col("scrape_date") == F.lit(as_day(as_of)))
    return out


def price_tails(history: DataFrame, as_of: str | date, rules: PriceRules = RULES) -> DataFrame:
    """The last rows per product up to a day: all that later rolling features need of the past."""
    past = history.where(F.col("scrape_date") <= F.lit(as_day(as_of)))
    rows = max(rules.window_rows, rules.lag_rows + 1)
    return last_rows_per(past, ["asin"], "scrape_date", rows)


def window_comparison(history: DataFrame, windows: tuple[int, ...] = (3, 7, 14)) -> DataFrame:
    """Moving averages and deviations for several window lengths in one pass."""
    timeline = Window.partitionBy("asin").orderBy("scrape_date")
    columns = []
    for size in windows:
        frame = timeline.rowsBetween(1 - size, 0)
        columns += [
            F.avg("price").over(frame).alias(f"ma_{size}d"),
            F.stddev("price").over(frame).alias(f"vol_{size}d"),
        ]
    return history.select("asin", "scrape_date", "price", *columns)


def competitor_landscape(
    competitor_map: DataFrame,
    own: DataFrame | None = None,
    exact: bool = False,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Competitor price statistics per (asin, day), including how many are cheaper.

    The map already carries the signed difference to the own price, so counting cheaper
    competitors needs no join: one aggregation, combined before its shuffle. Pass ``own``
    (asin, scrape_date, price) only to compare with other prices than the map's.
    ``exact`` uses the interpolated median instead of the approximate percentile.
    """
    rows = competitor_map.where(F.col("price").isNotNull()).withColumnRenamed("asin", "_rival")
    rows = rows.withColumnRenamed("parent_asin", "asin")
    keys = ["asin", "scrape_date"]
    if own is not None:
        rows = rows.join(own.select(*keys, F.col("price").alias("_own")), keys, "left")
        below = F.col("price") < F.col("_own")
    else:
        below = F.col("price_diff_pct") < 0
    statistics = [
        F.avg("price").alias("comp_avg_price"),
        F.min("price").alias("comp_min_price"),
        F.max("price").alias("comp_max_price"),
        F.count(F.lit(1)).cast("int").alias("comp_count"),
        F.avg("rating").alias("comp_avg_rating"),
        F.sum(below.cast("int")).cast("int").alias("competitors_below"),
    ]
    if exact:
        return exact_percentiles(
            rows, keys, "price", {"comp_median_price": 0.5}, statistics, hot_rows
        )
    return rows.groupBy(*keys).agg(
        F.percentile_approx("price", 0.5).alias("comp_median_price"), *statistics
    )


def gold_price_features(
    rolling: DataFrame, landscape: DataFrame, rules: PriceRules = RULES
) -> DataFrame:
    """One feature row per own product and day."""
    joined = rolling.join(landscape, ["asin", "scrape_date"], "left")
    price, median = F.col("price"), F.col("comp_median_price")
    premium = pricing.rating_premium(F.col("rating"), F.col("comp_avg_rating"), rules)
    return joined.select(
        "asin",
        "scrape_date",
        price.alias("current_price"),
        "currency",
        "price_7d_ma",
        "price_7d_volatility",
        "price_momentum",
        "comp_median_price",
        "comp_avg_price",
        "comp_min_price",
        "comp_max_price",
        "comp_count",
        "competitors_below",
        pricing.pressure(F.col("competitors_below"), F.col("comp_count")).alias(
            "comp_pressure_score"
        ),
        pricing.suggested_price(median, premium).alias("suggested_price"),
        pricing.price_position(price, median, rules.position_band).alias("price_position"),
    )


def gold_from_silver(
    price_history: DataFrame,
    competitor_map: DataFrame,
    as_of: str | date | None = None,
    exact: bool = False,
    rules: PriceRules = RULES,
    history: DataFrame | None = None,
) -> DataFrame:
    """Gold rows of one day, or of every day when ``as_of`` is not given.

    ``history`` replaces the own-price rows of ``price_history``, for instance by the
    tails of the day before plus the new day.
    """
    rivals = competitor_map
    if as_of is not None:
        rivals = rivals.where(F.col("scrape_date") == F.lit(as_day(as_of)))
    history = own_prices(price_history) if history is None else history
    rolling = rolling_features(history, rules.window_rows, rules.lag_rows, as_of=as_of)
    return gold_price_features(rolling, competitor_landscape(rivals, exact=exact), rules)


def feature_view(gold: DataFrame) -> DataFrame:
    """Rounded gold columns for reading."""
    return gold.select(
        "asin",
        "scrape_date",
        "current_price",
        pricing.rounded(F.col("price_7d_ma"), 2).alias("price_7d_ma"),
        pricing.rounded(F.col("price_7d_volatility"), 4).alias("price_7d_vol"),
        pricing.rounded(F.col("price_momentum") * 100, 2).alias("momentum_pct"),
        "comp_count",
        pricing.rounded(F.col("comp_median_price"), 2).alias("comp_median"),
        pricing.rounded(F.col("comp_pressure_score"), 3).alias("pressure"),
        "suggested_price",
        "price_position",
    )


def price_vs_average(gold: DataFrame) -> DataFrame:
    """Raw price minus its moving average."""
    return gold.select(
        "asin",
        "scrape_date",
        "current_price",
        "price_7d_ma",
        (F.col("current_price") - F.col("price_7d_ma")).alias("diff"),
    )
