"""Profiling queries over the bronze, silver and gold tables."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.binning import day_name, label_of, monday_zero, right_closed_index
from ..functions.pricing import ratio, rounded, settle
from ..rules import DIFF_EDGES, DIFF_LABELS, FEATURE_COLUMNS, RATING_EDGES, RATING_LABELS, RULES
from ..session import literal_rows, stored
from .gold import window_comparison
from .ordered import exact_percentiles
from .selection import column_statistics

_QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def _rows() -> Column:
    return F.count(F.lit(1)).alias("rows")


def _share(condition: Column) -> Column:
    """Fraction of rows that meet the condition, null counting as not met."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double"))


# --- coverage and completeness -------------------------------------------------


def rows_per_day(df: DataFrame, time: str, distinct: Sequence[str] = ()) -> DataFrame:
    """Rows per calendar day of ``time``, with distinct counts of the given columns."""
    return df.groupBy(F.to_date(time).alias("scrape_date")).agg(
        _rows(), *[F.count_distinct(c).alias(f"unique_{c}") for c in distinct]
    )


def rows_by_source(price_history: DataFrame) -> DataFrame:
    return price_history.groupBy("source").agg(_rows(), F.count_distinct("asin").alias("unique_asins"))


def coverage(df: DataFrame, name: str, key: str, time: str, second_key: str | None = None) -> DataFrame:
    """One row: size, distinct keys and date range of a table."""
    second = F.count_distinct(second_key) if second_key else F.lit(None).cast("long")
    return df.agg(
        F.lit(name).alias("table_name"),
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(key).alias("unique_keys"),
        second.alias("unique_parents"),
        F.to_date(F.min(time)).alias("earliest"),
        F.to_date(F.max(time)).alias("latest"),
    )


def null_rates(df: DataFrame, columns: Sequence[str] | None = None, flag_above: float = 10.0) -> DataFrame:
    """Null count and percentage of every column in one pass."""
    columns = list(columns or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("null_count")) for c in columns]
    )
    pct = rounded(ratio(F.col("null_count") * F.lit(100.0), F.col("_rows").cast("double")), 1)
    return (
        counted.select("_rows", F.inline(pairs))
        .select("column", "null_count", pct.alias("null_pct"))
        .withColumn("flagged", F.col("null_pct") > flag_above)
        .orderBy(F.desc("null_pct"), "column")
    )


def category_share(df: DataFrame, column: str) -> DataFrame:
    """Rows per category and its percentage of all rows."""
    total = F.sum("rows").over(Window.partitionBy())
    return (
        df.groupBy(column)
        .agg(_rows())
        .withColumn("pct", rounded(F.col("rows").cast("double") * 100 / total, 1))
        .orderBy(F.desc("rows"), column)
    )


def history_depth(gold: DataFrame, minimum: int = 7) -> DataFrame:
    """Days of history per product and whether that is enough to train on."""
    days = gold.groupBy("asin").agg(F.count(F.lit(1)).alias("days_of_history"))
    return days.withColumn("qualified", F.col("days_of_history") >= minimum)


def feature_table_profile(gold: DataFrame) -> DataFrame:
    """Size, keys and date range of the feature table, and how many keys are repeated."""
    per_key = gold.groupBy("asin", "scrape_date").agg(_rows())
    return per_key.agg(
        F.sum("rows").alias("total_rows"),
        F.count_distinct("asin").alias("unique_asins"),
        F.min("scrape_date").alias("earliest"),
        F.max("scrape_date").alias("latest"),
        F.count_if(F.col("rows") > 1).alias("repeated_keys"),
    )


def latest_rows(gold: DataFrame, k: int = 10) -> DataFrame:
    """A look at the newest rows of the feature table."""
    return (
        gold.orderBy(F.desc("scrape_date"), "asin")
        .limit(k)
        .select(
            "asin",
            "scrape_date",
            "current_price",
            "suggested_price",
            "price_position",
            "comp_count",
            rounded(F.col("comp_pressure_score"), 3).alias("pressure"),
        )
    )


# --- distributions ---------------------------------------------------------------


_DESCRIBED = T.StructType(
    [T.StructField("feature", T.StringType()), T.StructField("count", T.LongType())]
    + [T.StructField(n, T.DoubleType()) for n in ("mean", "std", "min", "p25", "p50", "p75", "max")]
)


def describe(df: DataFrame, columns: Sequence[str], shares: dict[str, Column] | None = None) -> DataFrame:
    """count, mean, std, min, exact quartiles and max of each column, nulls left out.

    ``shares`` are further averages of the same pass, repeated on every row.
    """
    shares = shares or {}
    rows, extra = column_statistics(df, columns, _QUARTILES, list(shares.values()))
    schema = T.StructType(_DESCRIBED.fields + [T.StructField(n, T.DoubleType()) for n in shares])
    cells = [tuple(r[n] for n in _DESCRIBED.names) + tuple(extra.values()) for r in rows]
    return literal_rows(df.sparkSession, cells, schema)


def _describe_aggregates(column: str) -> list[Column]:
    """``describe`` for groups whose size is bounded by the number of days."""
    return [
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev(column).alias("std"),
        F.min(column).alias("min"),
        *[F.percentile(column, F.lit(p)).alias(n) for n, p in _QUARTILES.items()],
        F.max(column).alias("max"),
    ]


def price_percentiles(df: DataFrame, points: Sequence[int] = (5, 25, 50, 75, 90, 95, 99)) -> DataFrame:
    """Interpolated percentiles of the price over all rows."""
    return exact_percentiles(df, [], "price", {f"p{p}": p / 100 for p in points})


def price_stats_per_key(own: DataFrame) -> DataFrame:
    """Range, deviation and coefficient of variation per product."""
    std = F.stddev("price")
    return own.groupBy("asin").agg(
        F.count(F.lit(1)).alias("days"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        std.alias("std"),
        (std / F.nullif(F.avg("price"), F.lit(0.0))).alias("cv"),
    )


def dow_seasonality(own: DataFrame) -> DataFrame:
    """Price by weekday, its distance from the overall mean, and the spread over weekdays."""
    days = exact_percentiles(
        own.withColumn("dow", monday_zero(F.col("scrape_date"))),
        ["dow"],
        "price",
        {"median_price": 0.5},
        [
            F.min(day_name(F.col("scrape_date"))).alias("day"),
            F.avg("price").alias("mean_price"),
            F.stddev("price").alias("std"),
            F.count("price").alias("count"),
            F.sum("price").alias("_sum"),
        ],
    )
    week = Window.partitionBy()
    overall = F.sum("_sum").over(week) / F.sum("count").over(week)
    compared = days.withColumn(
        "vs_avg_pct", (F.col("mean_price") - overall) / F.nullif(overall, F.lit(0.0)) * 100
    )
    spread = F.max("vs_avg_pct").over(week) - F.min("vs_avg_pct").over(week)
    return compared.withColumn("spread_pct", spread).drop("_sum").orderBy("dow")


def volatility_ranking(gold: DataFrame) -> DataFrame:
    """Mean seven-row volatility per product."""
    return (
        gold.where(F.col("price_7d_volatility").isNotNull())
        .groupBy("asin")
        .agg(F.avg("price_7d_volatility").alias("mean_volatility"), _rows())
    )


def momentum_exceedance(gold: DataFrame, thresholds: Sequence[float] = (0.05, 0.10, 0.20)) -> DataFrame:
    """Share of rows whose absolute momentum exceeds each threshold."""
    size = settle(F.abs("price_momentum"))
    return gold.where(F.col("price_momentum").isNotNull()).agg(
        _rows(), *[_share(size > t).alias(f"over_{round(t * 100)}pct") for t in thresholds]
    )


# --- competitor landscape ----------------------------------------------------------


def rank_distribution(competitor_map: DataFrame, top: int = 10) -> DataFrame:
    """Competitors per price rank, for the best ranks."""
    return (
        competitor_map.groupBy("price_rank")
        .agg(F.count(F.lit(1)).alias("competitors"))
        .orderBy("price_rank")
        .limit(top)
    )


def rank_summary(competitor_map: DataFrame) -> DataFrame:
    return competitor_map.groupBy("parent_asin").agg(
        F.avg("price_rank").alias("avg_rank"),
        F.min("price_rank").alias("min_rank"),
        F.max("price_rank").alias("max_rank"),
    )


def _by_parent_and_overall(per_day: DataFrame, column: str) -> DataFrame:
    """Describe a per-(parent, day) figure for each parent and over all rows."""
    per_day = stored(per_day, "per_day")
    parents = per_day.groupBy("parent_asin").agg(*_describe_aggregates(column))
    overall = describe(per_day, [column]).withColumn("feature", F.lit("(all)"))
    return parents.unionByName(overall.withColumnRenamed("feature", "parent_asin"))


def competitor_count_profile(competitor_map: DataFrame) -> DataFrame:
    per_day = competitor_map.groupBy("parent_asin", "scrape_date").agg(
        F.count("asin").alias("comp_count")
    )
    return _by_parent_and_overall(per_day, "comp_count")


def daily_spread(competitor_map: DataFrame) -> DataFrame:
    """Per (parent, day): price range in percent of the median, and median against mean."""
    per_day = exact_percentiles(
        competitor_map,
        ["parent_asin", "scrape_date"],
        "price",
        {"_median": 0.5},
        [F.min("price").alias("_min"), F.max("price").alias("_max"), F.avg("price").alias("_mean")],
    )
    median = F.col("_median")
    return per_day.select(
        "parent_asin",
        "scrape_date",
        ratio((F.col("_max") - F.col("_min")) * 100, median).alias("spread_pct"),
        ratio(F.abs(median - F.col("_mean")) * 100, median).alias("median_vs_mean_pct"),
    )


def price_spread(competitor_map: DataFrame) -> DataFrame:
    return _by_parent_and_overall(daily_spread(competitor_map), "spread_pct")


def diff_histogram(competitor_map: DataFrame) -> DataFrame:
    """Competitors per bin of price difference, with percentages of the binned rows."""
    index = right_closed_index(settle(F.col("price_diff_pct")), DIFF_EDGES)
    total = F.sum("rows").over(Window.partitionBy())
    return (
        competitor_map.groupBy(index.alias("bin"))
        .agg(_rows())
        .where(F.col("bin").isNotNull())
        .select(
            "bin",
            label_of(F.col("bin"), DIFF_LABELS).alias("diff_bucket"),
            "rows",
            rounded(F.col("rows").cast("double") * 100 / total, 1).alias("pct"),
        )
        .orderBy("bin")
    )


def _rated(competitor_map: DataFrame) -> DataFrame:
    return competitor_map.dropna(subset=["rating", "price"])


def rating_price_correlation(competitor_map: DataFrame) -> DataFrame:
    return _rated(competitor_map).agg(F.corr("rating", "price").alias("correlation"), _rows())


def rating_buckets(competitor_map: DataFrame) -> DataFrame:
    """Mean, median and count of prices per rating bucket."""
    index = right_closed_index(F.col("rating"), RATING_EDGES)
    binned = _rated(competitor_map).withColumn("bin", index).where(F.col("bin").isNotNull())
    stats = exact_percentiles(
        binned,
        ["bin"],
        "price",
        {"median_price": 0.5},
        [F.avg("price").alias("mean_price"), F.count("price").alias("count")],
    )
    return stats.withColumn("rating_bucket", label_of(F.col("bin"), RATING_LABELS))


def rank_stability(competitor_map: DataFrame) -> DataFrame:
    """Mean and deviation of the price rank of each competitor over the days."""
    return competitor_map.groupBy("parent_asin", "asin").agg(
        F.avg("price_rank").alias("avg_rank"),
        F.stddev("price_rank").alias("rank_std"),
        F.count("price_rank").alias("days_seen"),
    )


def mean_rank_deviation(competitor_map: DataFrame) -> DataFrame:
    return rank_stability(competitor_map).agg(F.avg("rank_std").alias("avg_rank_std"), _rows())


def pressure_bands(gold: DataFrame, low: float = 0.3, high: float = 0.7) -> DataFrame:
    """Distribution of the pressure score and the shares above, at and below market."""
    score = settle(F.col("comp_pressure_score"))
    share = lambda c: F.avg(F.when(score.isNotNull(), c.cast("double")))
    shares = {
        "above_share": share(score > high),
        "at_share": share(score.between(low, high)),
        "below_share": share(score < low),
    }
    return describe(gold, ["comp_pressure_score"], shares)


# --- sensitivity of the rules -------------------------------------------------------


def window_sensitivity(own: DataFrame, windows: tuple[int, ...] = (3, 7, 14)) -> DataFrame:
    """Correlation of the raw price with its moving average per window length."""
    wide = window_comparison(own, windows)
    return wide.agg(*[F.corr("price", f"ma_{w}d").alias(f"ma_{w}d") for w in windows])


def band_sensitivity(gold: DataFrame, bands: Sequence[float] = (0.03, 0.05, 0.10)) -> DataFrame:
    """Shares above, at and below market for several position bands."""
    rows = gold.dropna(subset=["current_price", "comp_median_price"])
    price, median = F.col("current_price"), F.col("comp_median_price")
    parts = [
        F.struct(
            F.lit(band).alias("band"),
            _share(settle(price - median * (1 + band)) > 0).alias("above"),
            _share(settle(price - median * (1 - band)) < 0).alias("below"),
        )
        for band in bands
    ]
    wide = rows.agg(F.array(*parts).alias("parts")).select(F.inline("parts"))
    return wide.select("band", "above", (1 - F.col("above") - F.col("below")).alias("at"), "below")


def rating_differences(price_history: DataFrame, competitor_map: DataFrame) -> DataFrame:
    """Own average rating against the average rating of the product's competitors."""
    own = (
        price_history.where("source = 'product' AND rating IS NOT NULL")
        .groupBy("asin")
        .agg(F.avg("rating").alias("own_avg_rating"))
    )
    rivals = competitor_map.groupBy(F.col("parent_asin").alias("asin")).agg(
        F.avg("rating").alias("comp_avg_rating")
    )
    return own.join(rivals, "asin").withColumn(
        "rating_diff", F.col("own_avg_rating") - F.col("comp_avg_rating")
    )


def premium_sensitivity(
    price_history: DataFrame,
    competitor_map: DataFrame,
    thresholds: Sequence[float] = (0.1, 0.2, 0.3, 0.5, 1.0),
) -> DataFrame:
    """Share of products that would earn the rating premium at each threshold."""
    diff = settle(F.col("rating_diff"))
    parts = [
        F.struct(F.lit(t).alias("threshold"), _share(diff > t).alias("share")) for t in thresholds
    ]
    rows = rating_differences(price_history, competitor_map)
    return rows.agg(F.array(*parts).alias("parts")).select(F.inline("parts"))


def feature_correlation(gold: DataFrame, columns: Sequence[str] = tuple(FEATURE_COLUMNS)) -> DataFrame:
    """Pearson correlation of every feature pair over rows without nulls, in one pass."""
    rows = gold.dropna(subset=list(columns))
    pairs = list(combinations(columns, 2))
    wide = rows.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = F.array(
        *[
            F.struct(
                F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"`{a}|{b}`").alias("r")
            )
            for a, b in pairs
        ]
    )
    return wide.select(F.inline(cells))


def correlated_pairs(gold: DataFrame, above: float = 0.8) -> DataFrame:
    return feature_correlation(gold).where(settle(F.abs("r")) > above)


def target_delta(gold: DataFrame) -> DataFrame:
    """Suggested minus current price: distribution and shares of raise, hold and cut."""
    rows = gold.dropna(subset=["suggested_price", "current_price"]).select(
        (F.col("suggested_price") - F.col("current_price")).alias("price_delta"),
        (
            ratio(F.col("suggested_price") - F.col("current_price"), F.col("current_price")) * 100
        ).alias("delta_pct"),
    )
    pct = settle(F.col("delta_pct"))
    shares = {
        "raise_share": _share(pct > 1),
        "hold_share": _share(F.abs(pct) <= 1),
        "cut_share": _share(pct < -1),
    }
    return describe(rows, ["price_delta", "delta_pct"], shares)
