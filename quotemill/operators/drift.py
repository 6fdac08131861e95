"""Two-sample Kolmogorov-Smirnov drift report."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binning import as_day
from ..functions.pricing import rounded
from ..rules import FEATURE_COLUMNS
from .features import unpivot
from .ordered import running_counts

# Terms of the limiting series.
TERMS = 100
# Significant digits by which two values count as different.
DIGITS = 12


def ks_p_value(statistic: Column, n: Column, m: Column) -> Column:
    """Two-sided p-value by Kolmogorov's limiting series, at every sample size."""
    scaled = statistic * F.sqrt(n * m / (n + m))
    total = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        F.lit(0.0),
        lambda sum_, k: sum_ + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2 * F.pow(k * scaled, F.lit(2))),
    )
    return F.when(scaled < 0.04, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))


def without_noise(value: Column) -> Column:
    """The value to ``DIGITS`` significant digits; NaN, infinities and tiny values as they are.

    Sums of the same numbers in another order differ in their last bits. Such values are ties.
    """
    size = F.abs(value)
    scale = F.pow(F.lit(10.0), F.lit(DIGITS - 1) - F.floor(F.log10(size)))
    plain = (size > 1e-290) & (size < float("inf"))
    return F.when(plain, F.rint(value * scale) / scale).otherwise(value)


def ks_statistics(
    samples: DataFrame, by: Sequence[str], value: str, current: str
) -> DataFrame:
    """KS distance, sizes and means of the rows where ``current`` is false versus true.

    Values that differ by the noise of their arithmetic only are one step of the distributions.
    """
    by = list(by)
    is_new = F.col(current)
    counts = samples.withColumn(value, without_noise(F.col(value))).groupBy(*by, value).agg(
        F.count_if(~is_new).alias("_b"), F.count_if(is_new).alias("_c")
    )
    placed = running_counts(counts, by, value, ["_b", "_c"])
    share_b = (F.col("_b_before") + F.col("_b")) / F.nullif("_b_total", F.lit(0))
    share_c = (F.col("_c_before") + F.col("_c")) / F.nullif("_c_total", F.lit(0))
    return placed.groupBy(*by).agg(
        F.max(F.abs(share_b - share_c)).alias("ks_statistic"),
        F.max("_b_total").alias("baseline_rows"),
        F.max("_c_total").alias("current_rows"),
        F.try_divide(F.sum(F.col("_b") * F.col(value)), F.max("_b_total")).alias("baseline_mean"),
        F.try_divide(F.sum(F.col("_c") * F.col(value)), F.max("_c_total")).alias("current_mean"),
    )


def drift_statistics(
    gold: DataFrame,
    day: str | date,
    lookback: int = 30,
    features: Sequence[str] = tuple(FEATURE_COLUMNS),
) -> DataFrame:
    """KS distance and mean drift per feature between the past ``lookback`` days and ``day``.

    Rows with any null feature are dropped first. Features are empty when one side is.
    """
    end = as_day(day)
    rows = gold.where(
        (F.col("scrape_date") >= F.lit(end - timedelta(days=lookback)))
        & (F.col("scrape_date") <= F.lit(end))
    ).dropna(subset=list(features))
    flagged = rows.select(*features, (F.col("scrape_date") == F.lit(end)).alias("_current"))
    samples = unpivot(flagged, features, ["_current"])
    stats = ks_statistics(samples, ["feature"], "value", "_current")
    base, new = F.col("baseline_mean"), F.col("current_mean")
    drift = F.when(base != 0, F.abs(new - base) / F.abs(base) * 100).otherwise(0.0)
    return stats.where("baseline_rows > 0 AND current_rows > 0").withColumn("mean_drift_pct", drift)


def drift_report(
    gold: DataFrame,
    day: str | date,
    lookback: int = 30,
    p_thresh: float = 0.05,
    mean_thresh: float = 20.0,
    features: Sequence[str] = tuple(FEATURE_COLUMNS),
) -> DataFrame:
    """Rounded report, drifted features first; the flag uses unrounded figures."""
    stats = drift_statistics(gold, day, lookback, features)
    p_value = ks_p_value(F.col("ks_statistic"), F.col("baseline_rows"), F.col("current_rows"))
    tested = stats.withColumn("_p", p_value)
    drifted = (F.col("_p") < p_thresh) | (F.col("mean_drift_pct") > mean_thresh)
    return tested.select(
        "feature",
        rounded(F.col("ks_statistic"), 4).alias("ks_statistic"),
        rounded(F.col("_p"), 4).alias("p_value"),
        rounded(F.col("baseline_mean"), 4).alias("baseline_mean"),
        rounded(F.col("current_mean"), 4).alias("current_mean"),
        rounded(F.col("mean_drift_pct"), 2).alias("mean_drift_pct"),
        drifted.alias("drifted"),
    ).orderBy(F.desc("drifted"), "feature")


def drift_summary(report: DataFrame) -> DataFrame:
    """Number and names of drifted features; status says when there was nothing to test."""
    names = F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("feature"))))
    # The texts of the status.
    return report.agg(
        F.count_if("drifted").alias("drifted_feature_count"),
        F.concat_ws(",", names).alias("drifted_features"),
        F.when(F.count(F.lit(1)) == 0, "skipped — insufficient data")
        .when(F.count_if("drifted") > 0, "drift detected")
        .otherwise("no drift")
        .alias("status"),
    )
