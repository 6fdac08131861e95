"""Data-quality checks: one aggregation per table, one result row per check."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import valid_key
from .merge import duplicate_keys


# Names, limits and order of the checks.
def _row_checks(now: Column) -> dict[str, dict[str, Column]]:
    c = F.col
    return {
        "bronze.products": {
            "null ASIN": c("asin").isNull(),
            "zero or negative price": c("price") <= 0,
            "future scraped_at": c("scraped_at") > now + F.expr("INTERVAL 1 HOUR"),
            "invalid ASIN format": ~valid_key(c("asin")),
            "null currency": c("currency").isNull(),
        },
        "bronze.competitors": {
            "null ASIN": c("asin").isNull() | c("parent_asin").isNull(),
            "zero or negative price": c("price") <= 0,
        },
        "silver.price_history": {
            "null price": c("price").isNull(),
            "price out of range": (c("price") < 0.01) | (c("price") > 100000),
            "invalid source": ~c("source").isin("product", "competitor"),
        },
        "gold.price_features": {
            "comp_pressure_score out of range": ~c("comp_pressure_score").between(0, 1),
            "invalid price_position": ~c("price_position").isin(
                "above_market", "at_market", "below_market"
            ),
        },
    }


# Keys that must not repeat.
_UNIQUE_KEYS = {
    "silver.price_history": ("asin", "scrape_date", "source", "parent_asin"),
    "gold.price_features": ("asin", "scrape_date"),
}


def quality_report(
    tables: dict[str, DataFrame],
    now: datetime | Column | None = None,
    only_failures: bool = False,
) -> DataFrame:
    """(table_name, check_name, failing_rows, passed) for the given tables."""
    if now is None:
        now = F.current_timestamp()
    elif not isinstance(now, Column):
        now = F.lit(now)
    checks = _row_checks(now)
    parts = []
    for table, df in tables.items():
        rules = checks[table]
        counted = df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
        rows = F.array(
            *[F.struct(F.lit(n).alias("check_name"), F.col(f"`{n}`").alias("failing_rows")) for n in rules]
        )
        parts.append(counted.select(F.lit(table).alias("table_name"), F.inline(rows)))
        if table in _UNIQUE_KEYS:
            keys = _UNIQUE_KEYS[table]
            parts.append(
                duplicate_keys(df, keys)
                .agg(F.count(F.lit(1)).alias("failing_rows"))
                .select(
                    F.lit(table).alias("table_name"),
                    F.lit(f"duplicate ({', '.join(keys)})").alias("check_name"),
                    "failing_rows",
                )
            )
    report = reduce(DataFrame.unionByName, parts)
    report = report.withColumn("passed", F.col("failing_rows") == 0)
    return report.where("NOT passed") if only_failures else report


def missing_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in df.columns]


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    absent = missing_columns(df, columns)
    if absent:
        raise ValueError("Missing required columns: " + ", ".join(absent))


def require_rows(df: DataFrame, minimum: int, context: str = "") -> None:
    """Raise when there are fewer rows; counting stops at ``minimum``."""
    found = df.limit(minimum).count()
    if found < minimum:
        note = f"Only {found} rows available, at least {minimum} are required"
        raise ValueError(" ".join(filter(None, (note, context))))


def require_null_fraction(
    df: DataFrame, columns: Sequence[str], max_null_fraction: float = 0.5
) -> None:
    """Raise for columns with too many nulls; all of them are measured in one aggregation."""
    measured = [c for c in columns if c in df.columns]
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in measured]).first()
    over = {c: row[c] for c in measured if (row[c] or 0.0) > max_null_fraction}
    if over:
        found = ", ".join(f"{c} {share:.1%}" for c, share in over.items())
        raise ValueError(f"Too many nulls (at most {max_null_fraction:.1%} allowed): {found}")
