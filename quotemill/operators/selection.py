"""Exact order statistics of whole columns from mergeable sketches and counting passes.

A first pass makes one KLL sketch per column beside the moments. The sketch bounds each
wanted order statistic by two values; a second pass counts the rows below the lower one and
gathers the distinct values between them with their counts, combined map-side. Where too
many rows lie between the bounds, further passes sketch just these and narrow the bounds.
The counts prove each result: a bound that the sketch got wrong is widened to the end of the
column. All columns and points share every pass; nothing is sorted or moved but the few
values between bounds.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..session import stored

#: Size of a sketch, and the share of ranks by which its answers may be off at most (three
#: times the error it is built for).
SKETCH_K, RANK_ERROR = 2000, 0.0075
#: Even ranks at which a sketch is read.
GRID = 400
#: Rows between two bounds below which their values are gathered.
GATHERED_ROWS = 1_000_000


@dataclass
class Wanted:
    """One interpolated order statistic: its two ranks, and bounds for their values.

    ``rows`` is how many rows are expected between the bounds.
    """

    column: str
    name: str
    low: int
    high: int
    share: float
    rows: float
    least: float = -math.inf
    most: float = math.inf
    value: float | None = None

    def bound(self, ends, rows: float) -> None:
        low, high = ends
        self.least = self.least if low is None else low
        self.most = self.most if high is None else high
        self.rows = rows


def _number(column: str) -> Column:
    """Values as doubles without NaN, which has its place behind all others."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def _below(w: Wanted) -> Column:
    return F.count_if(_number(w.column) < F.lit(w.least))


def _between(w: Wanted) -> Column:
    return _number(w.column).between(F.lit(w.least), F.lit(w.most))


def _grid(sketch: str, values: Column) -> Column:
    """The sketch's values at ``GRID + 1`` even ranks, null without any value."""
    ranks = F.array(*[F.lit(k / GRID) for k in range(GRID + 1)])
    return F.when(values > 0, F.kll_sketch_get_quantile_double(sketch, ranks))


def _ends(grid: Sequence[float], share: float) -> tuple[float | None, float | None]:
    """Values of the grid around a share of the ranks; None where that is an end."""
    low, high = math.floor((share - RANK_ERROR) * GRID), math.ceil((share + RANK_ERROR) * GRID)
    return (grid[low] if low > 0 else None), (grid[high] if high < GRID else None)


def _narrow(df: DataFrame, wanted: Sequence[Wanted]) -> None:
    """Passes over the rows until few are left between the bounds of each order statistic."""
    large = [w for w in wanted if w.rows > GATHERED_ROWS]
    while large:
        sums, shown = [], []
        for i, w in enumerate(large):
            inside = F.when(_between(w), _number(w.column))
            sums += [_below(w).alias(f"b{i}"), F.count(inside).alias(f"n{i}"), F.kll_sketch_agg_double(inside, F.lit(SKETCH_K)).alias(f"s{i}")]
            shown += [f"b{i}", f"n{i}", _grid(f"s{i}", F.col(f"n{i}")).alias(f"g{i}")]
        row = df.agg(*sums).select(*shown).first()
        left = []
        for i, w in enumerate(large):
            below, inside, before = row[f"b{i}"], row[f"n{i}"], w.rows
            if below > w.low or below + inside <= w.high:
                w.least = -math.inf if below > w.low else w.least
                w.most = math.inf if below + inside <= w.high else w.most
                left.append(w)
                continue
            w.bound(_ends(row[f"g{i}"], (w.low - below) / inside), inside * 2 * (RANK_ERROR + 1 / GRID))
            if GATHERED_ROWS < w.rows < before / 2:
                left.append(w)
        large = left


def _gather(df: DataFrame, wanted: Sequence[Wanted]) -> None:
    """Read the order statistics off the counts of the distinct values between the bounds.

    The rows below are counted by the same pass.
    """
    seen = Observation()
    cells = [F.when(_between(w), F.struct(F.lit(i).alias("target"), _number(w.column).alias("value"))) for i, w in enumerate(wanted)]
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[_below(w).alias(f"b{i}") for i, w in enumerate(wanted)])
    values = watched.select(F.inline(F.array_compact(F.array(*cells))))
    kept = stored(values.groupBy("target", "value").agg(F.count(F.lit(1)).alias("n")), "order_statistics")
    below = seen.get
    upto = F.sum("n").over(Window.partitionBy("target").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    ranks = [F.struct(F.lit(w.low - below[f"b{i}"]).alias("low"), F.lit(w.high - below[f"b{i}"]).alias("high")) for i, w in enumerate(wanted)]
    rank = F.element_at(F.array(*ranks), F.col("target") + 1)

    def at(r: Column) -> Column:
        return F.max(F.when((F.col("upto") > r) & (F.col("upto") - F.col("n") <= r), F.col("value")))

    found = kept.withColumn("upto", upto).groupBy("target").agg(at(rank["low"]).alias("low"), at(rank["high"]).alias("high"))
    ends = {r["target"]: r for r in found.collect()}
    missed = []
    for i, w in enumerate(wanted):
        low, high = (ends[i]["low"], ends[i]["high"]) if i in ends else (None, None)
        if low is None or high is None:
            w.least, w.most = -math.inf, math.inf
            missed.append(w)
        else:
            w.value = low if low == high else low * (1 - w.share) + high * w.share
    if missed:
        _gather(df, missed)


def column_statistics(
    df: DataFrame, columns: Sequence[str], points: dict[str, float], extra: Sequence[Column] = ()
) -> tuple[list[dict], dict]:
    """Per column count, mean, std, min, max and the interpolated ``points``; and ``extra``.

    Exact, nulls left out, NaN the greatest value. Two passes over ``df`` where fewer than
    some 50 million rows have a value, one more per factor of 50 beyond. ``extra`` are further
    aggregates of the same first pass. Only these few figures come to the driver.
    """
    sums, shown = [], []
    for i, c in enumerate(columns):
        value = F.col(c).cast("double")
        sums += [
            F.count(c).alias(f"count{i}"), F.count_if(F.isnan(value)).alias(f"nans{i}"), F.avg(c).alias(f"mean{i}"),
            F.stddev(c).alias(f"std{i}"), F.min(c).cast("double").alias(f"min{i}"), F.max(c).cast("double").alias(f"max{i}"),
            F.kll_sketch_agg_double(_number(c), F.lit(SKETCH_K)).alias(f"sketch{i}"),
        ]
        shown += [f"{k}{i}" for k in ("count", "nans", "mean", "std", "min", "max")]
        shown.append(_grid(f"sketch{i}", F.col(f"count{i}") - F.col(f"nans{i}")).alias(f"grid{i}"))
    names = [f"_extra{k}" for k in range(len(extra))]
    row = df.agg(*sums, *[e.alias(n) for n, e in zip(names, extra)]).select(*shown, *names).first()
    rows, wanted = [], []
    for i, c in enumerate(columns):
        facts = {k: row[f"{k}{i}"] for k in ("count", "mean", "std", "min", "max")}
        rows.append({"feature": c, **facts})
        numbers = facts["count"] - row[f"nans{i}"]
        for name, p in points.items():
            spot = p * (facts["count"] - 1)
            w = Wanted(c, name, math.floor(spot), math.ceil(spot), spot - math.floor(spot), numbers)
            if facts["count"] and w.high >= numbers:
                rows[-1][name] = math.nan
            elif facts["count"]:
                w.bound(_ends(row[f"grid{i}"], spot / numbers), numbers * 2 * (RANK_ERROR + 1 / GRID))
                wanted.append(w)
            else:
                rows[-1][name] = None
    _narrow(df, wanted)
    if wanted:
        _gather(df, wanted)
    found = {(w.column, w.name): w.value for w in wanted}
    for r in rows:
        r.update({name: found[(r["feature"], name)] for name in points if (r["feature"], name) in found})
    return rows, dict(zip(range(len(extra)), [row[n] for n in names]))
