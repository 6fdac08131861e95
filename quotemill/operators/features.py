"""Model inputs: training rows, imputation, time split, sequences, point-in-time lookup."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.binning import monday_zero
from ..functions.pricing import ratio
from ..rules import MODEL_COLUMNS, SEQUENCE_COLUMNS, TARGET_COLUMN
from ..session import literal_rows
from .selection import column_statistics


def with_min_history(df: DataFrame, days: int = 7) -> DataFrame:
    """Rows of products with at least ``days`` rows (one row per product and day)."""
    count = F.count(F.lit(1)).over(Window.partitionBy("asin"))
    return df.withColumn("_days", count).where(F.col("_days") >= days).drop("_days")


def engineered(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "day_of_week": monday_zero(F.col("scrape_date")),
            "price_to_median_ratio": ratio(F.col("current_price"), F.col("comp_median_price")),
        }
    )


def training_frame(gold: DataFrame, min_history: int = 7) -> DataFrame:
    """Rows fit for training, with the engineered columns; not yet imputed."""
    complete = gold.dropna(subset=[TARGET_COLUMN, "current_price", "comp_median_price"])
    return engineered(with_min_history(complete, min_history))


def unpivot(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep…, feature, value) with every column as double; nulls are dropped."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    return df.select(*keep, F.inline(pairs)).where(F.col("value").isNotNull())


def fit_medians(df: DataFrame, columns: Sequence[str] = tuple(MODEL_COLUMNS)) -> DataFrame:
    """One row holding the exact median of each column."""
    rows, _ = column_statistics(df, columns, {"median": 0.5})
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in columns])
    return literal_rows(df.sparkSession, [tuple(r["median"] for r in rows)], schema)


def impute(df: DataFrame, medians: DataFrame) -> DataFrame:
    """Fill nulls with the fitted medians; a column without any value becomes 0.0."""
    names = medians.columns
    fitted = medians.select(*[F.col(c).alias(f"_median_{c}") for c in names])
    filled = {
        c: F.coalesce(F.col(c).cast("double"), F.col(f"_median_{c}"), F.lit(0.0)) for c in names
    }
    return df.crossJoin(F.broadcast(fitted)).withColumns(filled).select(*df.columns)


def _split_hash() -> Column:
    return F.md5(F.col("asin"))


def split_point(df: DataFrame, test_size: float = 0.2) -> DataFrame:
    """One row (_day, _hash): the last training position in (date, md5(asin)) order.

    Rows are counted per date, then per hash prefix of the boundary date, then ranked
    inside the one boundary prefix: each step sees a bounded number of rows or 1/4096 of
    one day. Spreading the boundary date by hash keeps a date that holds a large part of
    all rows out of a single task; rows of equal date have no natural order.
    """
    by_day = df.groupBy("scrape_date").agg(F.count(F.lit(1)).alias("_n"))
    days = Window.orderBy("scrape_date").rowsBetween(Window.unboundedPreceding, -1)
    placed = by_day.select(
        "scrape_date",
        "_n",
        F.coalesce(F.sum("_n").over(days), F.lit(0)).alias("_before"),
        F.floor(F.sum("_n").over(Window.partitionBy()) * (1 - test_size)).alias("_target"),
    )
    boundary = placed.where(
        (F.col("_before") < F.col("_target")) & (F.col("_target") <= F.col("_before") + F.col("_n"))
    ).select("scrape_date", (F.col("_target") - F.col("_before")).alias("_left"))
    day_rows = df.join(F.broadcast(boundary), "scrape_date").select(
        "scrape_date", "_left", _split_hash().alias("_hash")
    )
    prefix = F.substring("_hash", 1, 3)
    by_prefix = day_rows.groupBy("scrape_date", "_left", prefix.alias("_prefix")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    prefixes = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    chosen = (
        by_prefix.withColumn("_before", F.coalesce(F.sum("_n").over(prefixes), F.lit(0)))
        .where((F.col("_before") < F.col("_left")) & (F.col("_left") <= F.col("_before") + F.col("_n")))
        .select("scrape_date", "_prefix", (F.col("_left") - F.col("_before")).alias("_rest"))
    )
    inside = Window.partitionBy("scrape_date", "_prefix").orderBy("_hash")
    return (
        day_rows.withColumn("_prefix", prefix)
        .join(F.broadcast(chosen), ["scrape_date", "_prefix"])
        .withColumn("_at", F.row_number().over(inside))
        .where("_at = _rest")
        .select(F.col("scrape_date").alias("_day"), "_hash")
    )


def mark_split(df: DataFrame, test_size: float = 0.2) -> DataFrame:
    """Add ``is_train``: exactly floor(n * (1 - test_size)) oldest rows are true."""
    point = split_point(df, test_size)
    train = (F.col("scrape_date") < F.col("_day")) | (
        (F.col("scrape_date") == F.col("_day")) & (_split_hash() <= F.col("_hash"))
    )
    return (
        df.join(F.broadcast(point), F.lit(True), "left")
        .withColumn("is_train", F.coalesce(train, F.lit(False)))
        .drop("_day", "_hash")
    )


def time_split(df: DataFrame, test_size: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """(train, test): oldest rows train, newest rows test."""
    marked = mark_split(df, test_size)
    return marked.where("is_train").drop("is_train"), marked.where("NOT is_train").drop("is_train")


def sequence_windows(
    gold: DataFrame,
    seq_len: int = 7,
    features: Sequence[str] = tuple(SEQUENCE_COLUMNS),
    target: str = TARGET_COLUMN,
) -> DataFrame:
    """The ``seq_len`` rows before each row as an array of feature arrays, plus its target.

    The frame is bounded, so memory per row is too. Windows with any null are left out.
    """
    frame = Window.partitionBy("asin").orderBy("scrape_date").rowsBetween(-seq_len, -1)
    step = F.array(*[F.col(c).cast("double") for c in features])
    rows = gold.select(
        "asin",
        "scrape_date",
        F.collect_list(step).over(frame).alias("window"),
        F.col(target).alias("target"),
    )
    complete = F.forall("window", lambda s: F.forall(s, lambda v: v.isNotNull()))
    return rows.where((F.size("window") == seq_len) & F.col("target").isNotNull() & complete)


def standardise(df: DataFrame, columns: Sequence[str], train: DataFrame | None = None) -> DataFrame:
    """Subtract the training mean and divide by its population deviation + 1e-8."""
    fitted = (df if train is None else train).agg(
        *[F.avg(c).alias(f"_mean_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"_dev_{c}") for c in columns],
    )
    scaled = {
        c: (F.col(c) - F.col(f"_mean_{c}")) / (F.col(f"_dev_{c}") + F.lit(1e-8)) for c in columns
    }
    return df.crossJoin(F.broadcast(fitted)).withColumns(scaled).select(*df.columns)


def standardise_sequences(windows: DataFrame, train: DataFrame, width: int) -> DataFrame:
    """Standardise sequence windows per feature over all training rows and steps."""
    steps = train.select(F.explode("window").alias("step"))
    fitted = steps.agg(
        F.array(*[F.avg(F.get("step", F.lit(i))) for i in range(width)]).alias("_mean"),
        F.array(*[F.stddev_pop(F.get("step", F.lit(i))) for i in range(width)]).alias("_dev"),
    )

    def scale(step: Column) -> Column:
        return F.transform(
            step,
            lambda v, i: (v - F.get(F.col("_mean"), i)) / (F.get(F.col("_dev"), i) + F.lit(1e-8)),
        )

    return (
        windows.crossJoin(F.broadcast(fitted))
        .withColumn("window", F.transform("window", scale))
        .drop("_mean", "_dev")
    )


def point_in_time(
    labels: DataFrame,
    features: DataFrame,
    columns: Sequence[str],
    label_time: str,
    max_age_days: int | None = None,
) -> DataFrame:
    """Attach to each label the newest feature row of its product dated on or before it.

    Labels are reduced to distinct (asin, day) first, so the as-of window holds at most
    two rows per product and day; the labels themselves only meet an equi-join.
    """
    day = F.to_date(label_time)
    wanted = labels.select("asin", day.alias("_day")).distinct()
    found = F.struct(F.col("scrape_date").alias("feature_date"), *columns)
    known = features.select("asin", F.col("scrape_date").alias("_day"), found.alias("_found"))
    timeline = known.withColumn("_wanted", F.lit(False)).unionByName(
        wanted.withColumn("_wanted", F.lit(True)), allowMissingColumns=True
    )
    so_far = (
        Window.partitionBy("asin")
        .orderBy("_day", "_wanted")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    answers = timeline.withColumn("_found", F.last("_found", ignorenulls=True).over(so_far))
    answers = answers.where("_wanted").select("asin", "_day", "_found")
    if max_age_days is not None:
        fresh = F.date_diff("_day", F.col("_found.feature_date")) <= max_age_days
        answers = answers.withColumn("_found", F.when(fresh, F.col("_found")))
    return (
        labels.withColumn("_day", day)
        .join(answers, ["asin", "_day"], "left")
        .select(*labels.columns, "_found.*")
    )
