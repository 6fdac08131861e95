"""Right-closed bins and calendar columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def right_closed_index(col: Column, edges: Sequence[float]) -> Column:
    """Zero-based bin of ``(edge, next_edge]``; outside all bins is null."""
    index = F.when(col <= edges[0], F.lit(None).cast("int"))
    for i, upper in enumerate(edges[1:]):
        index = index.when(col <= upper, F.lit(i))
    return index


def label_of(index: Column, labels: Sequence[str]) -> Column:
    return F.get(F.array(*[F.lit(x) for x in labels]), index)


def monday_zero(col: Column) -> Column:
    return F.weekday(col)


def day_name(col: Column) -> Column:
    return F.date_format(col, "EEEE")


def as_day(day: str | date | None) -> date:
    """A run date; blank means today in UTC."""
    if isinstance(day, date):
        return day
    return date.fromisoformat(day) if day else datetime.now(timezone.utc).date()


def within_day(col: Column, day: str | date) -> Column:
    """Half-open range on the raw timestamp, so that file statistics can prune."""
    start = as_day(day)
    end = start + timedelta(days=1)
    return (col >= F.lit(start.isoformat()).cast("timestamp")) & (
        col < F.lit(end.isoformat()).cast("timestamp")
    )
