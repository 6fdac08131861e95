"""Snapshot and CSV files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.binning import as_day


def write_snapshots(
    df: DataFrame, root: str, kind: str, day: str | date, key: str | None = None
) -> str:
    """JSON snapshots under ``{root}/{kind}/{day}``.

    One line per row in as many files as there are partitions; with ``key`` the rows of a
    key go to their own folder ``{key}=…`` for consumers that look keys up by path.
    """
    path = f"{root.rstrip('/')}/{kind}/{as_day(day).isoformat()}"
    if key:
        df.withColumn(f"_{key}", F.col(key)).write.mode("overwrite").partitionBy(f"_{key}").json(path)
    else:
        df.write.mode("overwrite").json(path)
    return path


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
