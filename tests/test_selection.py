"""Order statistics by sketches and counts against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotemill.operators import selection
from quotemill.operators.selection import column_statistics

POINTS = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p77": 0.77, "p999": 0.999, "p100": 1.0}


@pytest.fixture(scope="module")
def table(spark):
    rows = spark.range(40_000, numPartitions=5)
    h = F.xxhash64("id")
    return rows.select(
        F.when(F.col("id") % 7 != 0, F.pmod(h, F.lit(1_000_003)) / 7.0).alias("even"),
        F.exp(F.pmod(h, F.lit(1000)) / 20.0).alias("skewed"),
        F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.pmod(h, F.lit(9)).cast("double")).alias("ties"),
        F.when(F.col("id") % 2 == 0, F.lit(float("nan"))).when(F.col("id") % 99 == 0, F.lit(float("-inf"))).otherwise(F.col("id") * 1.0).alias("odd"),
        F.lit(None).cast("double").alias("nothing"),
        F.col("id").alias("whole"),
    )


def expected(df, column):
    values = np.sort(np.array([float(r[0]) for r in df.select(column).collect() if r[0] is not None]))
    out = {}
    for name, p in POINTS.items():
        if not len(values):
            out[name] = None
            continue
        spot = p * (len(values) - 1)
        low, high = values[math.floor(spot)], values[math.ceil(spot)]
        share = spot - math.floor(spot)
        out[name] = low if low == high else low * (1 - share) + high * share
    return out


def same(a, b):
    return a is b or (a is not None and b is not None and (a == b or (math.isnan(a) and math.isnan(b)) or abs(a - b) <= 1e-9 * abs(b)))


def check(df):
    rows, _ = column_statistics(df, df.columns, POINTS)
    for row in rows:
        wanted = expected(df, row["feature"])
        assert {n: row[n] for n in POINTS if not same(row[n], wanted[n])} == {}, row["feature"]
    return rows


def test_equals_numpy(table):
    rows = check(table)
    assert rows[-1]["count"] == 40_000 and rows[-1]["max"] == 39_999.0 and rows[-2]["count"] == 0


def test_small_and_empty_tables(table):
    check(table.limit(1))
    check(table.limit(2))
    check(table.where("whole < 0"))


def test_narrowing_passes(table, monkeypatch):
    monkeypatch.setattr(selection, "GATHERED_ROWS", 20)
    check(table)


def test_wrong_bounds_are_widened(table, monkeypatch):
    """Bounds far tighter than the sketch allows: counts show it, the result stays exact."""
    monkeypatch.setattr(selection, "SKETCH_K", 8)
    monkeypatch.setattr(selection, "RANK_ERROR", 1e-7)
    check(table)
    monkeypatch.setattr(selection, "GATHERED_ROWS", 20)
    monkeypatch.setattr(selection, "RANK_ERROR", 1e-3)
    check(table)


def test_two_passes_over_the_input(spark, table):
    """One job for moments and sketches, one to select; the third reads what that one kept."""
    store = spark._jsparkSession.sharedState().statusStore()

    def newest():
        held = store.executionsList()
        return held.apply(held.size() - 1).executionId()

    before = newest()
    column_statistics(table, ["even", "skewed", "whole"], POINTS, [F.max("ties")])
    assert newest() - before == 3
