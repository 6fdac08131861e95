"""Linear models and correlations from one table of co-moments.

One native aggregation gives count, means and all co-moments of the chosen columns, per
segment of the rows if asked. Segments add up exactly, so growing prefixes, train and test
part, every ridge penalty, correlations and standardisation follow without another scan. The
table has as many numbers as pairs of columns, which is what the driver solves on.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..rules import MODEL_COLUMNS, TARGET_COLUMN
from ..session import literal_rows
from .features import _split_hash

PREDICTION = "predicted_price"


@dataclass(frozen=True)
class Gram:
    """Count, means and sums of centred products of ``columns``."""

    columns: tuple[str, ...]
    n: int
    mean: np.ndarray
    moment: np.ndarray

    def __add__(self, other: Gram) -> Gram:
        n = self.n + other.n
        if not self.n or not other.n:
            return self if self.n else other
        gap = other.mean - self.mean
        moment = self.moment + other.moment + np.outer(gap, gap) * self.n * other.n / n
        return Gram(self.columns, n, self.mean + gap * other.n / n, moment)

    def part(self, names: Sequence[str]) -> list[int]:
        return [self.columns.index(c) for c in names]


def grams(df: DataFrame, columns: Sequence[str], segment: Column | None = None) -> dict[int | None, Gram]:
    """Co-moments of rows without nulls or NaN in ``columns``, per value of ``segment``."""
    columns = tuple(columns)
    values = [F.col(c).cast("double").alias(c) for c in columns]
    named = df.select((F.lit(None).cast("int") if segment is None else segment.cast("int")).alias("_segment"), *values)
    pairs = list(combinations_with_replacement(range(len(columns)), 2))
    sums = [F.avg(c).alias(f"mean_{i}") for i, c in enumerate(columns)]
    sums += [F.covar_pop(columns[i], columns[j]).alias(f"m_{i}_{j}") for i, j in pairs]
    rows = named.dropna(subset=list(columns)).groupBy("_segment").agg(F.count(F.lit(1)).alias("n"), *sums).collect()
    found = {}
    for row in rows:
        moment = np.zeros((len(columns), len(columns)))
        for i, j in pairs:
            moment[i, j] = moment[j, i] = row[f"m_{i}_{j}"] * row["n"]
        mean = np.array([row[f"mean_{i}"] for i in range(len(columns))])
        found[row["_segment"]] = Gram(columns, row["n"], mean, moment)
    return found


def gram(df: DataFrame, columns: Sequence[str]) -> Gram:
    """Co-moments of all rows; of none, zeros."""
    k = len(columns)
    return grams(df, columns).get(None, Gram(tuple(columns), 0, np.zeros(k), np.zeros((k, k))))


@dataclass(frozen=True)
class Linear:
    """A linear model as plain numbers and as a column expression."""

    columns: tuple[str, ...]
    coefficients: np.ndarray
    intercept: float

    def column(self) -> Column:
        terms = [F.col(c).cast("double") * F.lit(float(b)) for c, b in zip(self.columns, self.coefficients)]
        return reduce(lambda a, b: a + b, terms, F.lit(float(self.intercept)))

    def predict(self, df: DataFrame, name: str = PREDICTION) -> DataFrame:
        return df.withColumn(name, self.column())

    def squared_error(self, rows: Gram, target: str = TARGET_COLUMN) -> float:
        """Sum of squared errors over the rows that a Gram table stands for."""
        weights = np.zeros(len(rows.columns))
        weights[rows.part(self.columns)] = -self.coefficients
        weights[rows.columns.index(target)] = 1.0
        bias = weights @ rows.mean - self.intercept
        return float(weights @ rows.moment @ weights + rows.n * bias * bias)


def ridge(rows: Gram, alpha: float = 1.0, target: str = TARGET_COLUMN, columns: Sequence[str] | None = None) -> Linear:
    """Ridge regression with penalty ``alpha`` on the plain coefficients, intercept free."""
    names = tuple(columns or [c for c in rows.columns if c != target])
    own, y = rows.part(names), rows.columns.index(target)
    left = rows.moment[np.ix_(own, own)] + alpha * np.eye(len(own))
    weights = np.linalg.solve(left, rows.moment[own, y])
    return Linear(names, weights, float(rows.mean[y] - weights @ rows.mean[own]))


def correlations(rows: Gram) -> dict[tuple[str, str], float]:
    """Pearson correlation of every pair; NaN where a column is constant."""
    deviation = np.sqrt(np.diag(rows.moment))
    with np.errstate(invalid="ignore", divide="ignore"):
        r = rows.moment / np.outer(deviation, deviation)
    k = len(rows.columns)
    return {(rows.columns[i], rows.columns[j]): float(r[i, j]) for i in range(k) for j in range(i + 1, k)}


def scales(rows: Gram) -> dict[str, tuple[float, float]]:
    """(mean, population deviation) per column, as standardisation needs them."""
    deviation = np.sqrt(np.diag(rows.moment) / max(rows.n, 1))
    return {c: (float(m), float(d)) for c, m, d in zip(rows.columns, rows.mean, deviation)}


def cut_points(df: DataFrame, sizes: Sequence[int]) -> list[tuple]:
    """For each size the (date, md5(asin)) of the last row of that prefix of the rows.

    All sizes share three jobs: rows per date, rows per hash prefix of the dates that hold a
    cut, and a rank inside these prefixes. What comes to the driver is bounded by the number
    of dates, 4,096 prefixes a cut, and one row a cut. A size of 0 gives (None, None).
    """
    per_day = df.groupBy("scrape_date").count().orderBy("scrape_date").collect()
    wanted, before, at = {}, 0, 0
    order = sorted({s for s in sizes if s > 0})
    for row in per_day:
        while at < len(order) and order[at] <= before + row["count"]:
            wanted[order[at]] = (row["scrape_date"], order[at] - before)
            at += 1
        before += row["count"]
    if not wanted:
        return [(None, None)] * len(sizes)
    rows = df.where(F.col("scrape_date").isin([d for d, _ in wanted.values()])).select(
        "scrape_date", _split_hash().alias("hash"), F.substring(_split_hash(), 1, 3).alias("prefix")
    )
    counts: dict = {}
    for r in rows.groupBy("scrape_date", "prefix").count().orderBy("scrape_date", "prefix").collect():
        counts.setdefault(r["scrape_date"], []).append((r["prefix"], r["count"]))
    places = []
    for size, (day, rank) in wanted.items():
        for prefix, n in counts[day]:
            if rank <= n:
                places.append((size, day, prefix, rank))
                break
            rank -= n
    schema = T.StructType(
        [T.StructField("size", T.LongType()), T.StructField("scrape_date", df.schema["scrape_date"].dataType),
         T.StructField("prefix", T.StringType()), T.StructField("rank", T.LongType())]
    )
    held = F.broadcast(literal_rows(df.sparkSession, places, schema))
    ranked = rows.join(held.select("scrape_date", "prefix").distinct(), ["scrape_date", "prefix"], "left_semi").withColumn(
        "rank", F.row_number().over(Window.partitionBy("scrape_date", "prefix").orderBy("hash")).cast("long")
    )
    found = {r["size"]: (r["scrape_date"], r["hash"]) for r in ranked.join(held, ["scrape_date", "prefix", "rank"]).collect()}
    return [found.get(s, (None, None)) for s in sizes]


def segment_of(cuts: Sequence[tuple]) -> Column:
    """Number of cuts that lie in front of a row."""
    place = F.struct(F.col("scrape_date"), _split_hash())
    behind = [
        (F.lit(1) if day is None else (place > F.struct(F.lit(day), F.lit(digest))).cast("int")) for day, digest in cuts
    ]
    return reduce(lambda a, b: a + b, behind, F.lit(0))


def ridge_learning_curve(
    train: DataFrame,
    test: DataFrame,
    fractions: Sequence[float] = (0.2, 0.4, 0.6, 0.8, 1.0),
    alpha: float = 1.0,
    columns: Sequence[str] = tuple(MODEL_COLUMNS),
) -> DataFrame:
    """Train and test rmse of ridge for growing prefixes, oldest rows first.

    Prefixes are sums of segments: one scan of the training rows, one of the test rows.
    """
    names = [*columns, TARGET_COLUMN]
    n = train.count()
    sizes = [max(2, int(round(n * f, 6))) for f in fractions]
    parts = grams(train, names, segment_of(cut_points(train, sizes)))
    outside = gram(test, names)
    rows = []
    for k, fraction in enumerate(fractions):
        prefix = reduce(lambda a, b: a + b, [g for s, g in parts.items() if s <= k])
        model = ridge(prefix, alpha, columns=columns)
        errors = [(max(0.0, model.squared_error(g)) / g.n) ** 0.5 if g.n else None for g in (prefix, outside)]
        rows.append((float(fraction), prefix.n, *errors))
    schema = T.StructType(
        [T.StructField("fraction", T.DoubleType()), T.StructField("train_rows", T.LongType()),
         T.StructField("train_rmse", T.DoubleType()), T.StructField("test_rmse", T.DoubleType())]
    )
    return literal_rows(train.sparkSession, rows, schema)
