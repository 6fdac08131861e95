"""The distributed plans give the same results as the plain ones."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotemill.operators import ordered
from quotemill.operators.gold import competitor_landscape
from quotemill.operators.ordered import (
    exact_percentiles,
    latest_per,
    percentiles_distributed,
    rank_rows,
    rank_rows_distributed,
    split_hot,
    value_bucket,
    value_cuts,
)
from quotemill.operators.serving import serving_price_stats
from quotemill.operators.silver import competitor_map
from quotemill.queries import binding as B


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """Group 'a' holds most rows, with many ties; 'b' is small; 'c' has one row."""
    rng = random.Random(7)
    data = [("a", round(rng.lognormvariate(3, 1), 1), i) for i in range(3000)]
    data += [("b", float(i % 4), i) for i in range(9)] + [("c", 5.0, 0)]
    return spark.createDataFrame(data, "k string, v double, id int").repartition(5).cache()


def test_split(skewed):
    split = split_hot(skewed, ["k"], 100)
    assert split.groups == 1
    assert {r.k for r in split.hot.select("k").distinct().collect()} == {"a"}
    assert {r.k for r in split.ordinary.select("k").distinct().collect()} == {"b", "c"}
    assert split_hot(skewed, ["k"], 10_000).hot is None


def test_groups_are_counted_only_below_a_hot_hash(skewed, monkeypatch):
    counted, plain = [], ordered.hot_groups
    monkeypatch.setattr(ordered, "hot_groups", lambda df, keys, limit: counted.append(list(keys)) or plain(df, keys, limit))
    assert split_hot(skewed, ["k"], 10_000).hot is None
    assert counted == [["_hash"]]
    # One hash for all groups: it is hot although no group is.
    monkeypatch.setattr(ordered, "KEY_HASHES", 1)
    assert split_hot(skewed, ["k"], 3005).hot is None
    assert counted[1:] == [["_hash"], ["k"]]
    assert {r.k for r in split_hot(skewed, ["k"], 2999).hot.select("k").distinct().collect()} == {"a"}


def test_percentiles(skewed):
    points = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    extra = [F.count(F.lit(1)).alias("n")]
    plain = exact_percentiles(skewed, ["k"], "v", points, extra)
    spread = exact_percentiles(skewed, ["k"], "v", points, extra, limit=5)
    for a, b in zip(rows(plain), rows(spread)):
        assert a[0] == b[0] and a[1:] == pytest.approx(b[1:])
    whole = exact_percentiles(skewed, [], "v", points).first()
    values = np.array([r.v for r in skewed.collect()])
    assert tuple(whole) == pytest.approx(tuple(np.percentile(values, [0, 10, 50, 99, 100])))


def test_percentiles_of_signed_values_and_nulls(spark):
    values = [-5.5, -0.2, 0.0, None, 0.2, 3.0, 1e9]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = percentiles_distributed(df, [], "v", {"a": 0.25, "b": 0.5}).first()
    kept = [v for v in values if v is not None]
    assert tuple(got) == pytest.approx(tuple(np.percentile(kept, [25, 50])))
    nothing = percentiles_distributed(df.where("v > 1e12"), [], "v", {"a": 0.5}).first()
    assert nothing.a is None


def test_buckets_are_even_and_ordered(spark):
    """Also for a million distinct values within a thousandth of zero."""
    df = spark.range(1_000_000).select(((F.col("id") - 500_000) / 1e9).alias("v"))
    cut = df.crossJoin(value_cuts(df, [], "v")).withColumn("b", value_bucket(F.col("_cuts"), F.col("v")))
    held = cut.groupBy("b").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).orderBy("b").collect()
    assert len(held) > 100 and max(r.n for r in held) < 4 * 1_000_000 / len(held)
    assert all(a.high < b.low for a, b in zip(held, held[1:]))


@pytest.mark.parametrize("seed", range(3))
def test_both_plans_agree_on_odd_values(spark, seed):
    rng = random.Random(seed)
    odd = [None, float("nan"), float("inf"), float("-inf"), -1.5, 0.0, 2.0, 2.0]
    data = [(rng.choice("ab"), rng.choice(odd + [rng.uniform(-3, 3)])) for _ in range(120)]
    df = spark.createDataFrame(data, "k string, v double")
    assert repr(rows(rank_rows_distributed(df, ["k"], "v", "r"))) == repr(rows(rank_rows(df, ["k"], "v", "r")))
    points = {"p0": 0.0, "p50": 0.5, "p100": 1.0}
    finite = df.where("v IS NULL OR v < 9")
    for a, b in zip(rows(exact_percentiles(finite, ["k"], "v", points)), rows(exact_percentiles(finite, ["k"], "v", points, limit=0))):
        assert a == b or a[1:] == pytest.approx(b[1:], nan_ok=True)


@pytest.fixture(scope="module")
def history(spark, sf):
    return B.stored_history(spark, sf)


def test_competitor_map(history):
    plain = competitor_map(history)
    assert rows(competitor_map(history, hot_rows=6)) == rows(plain)
    assert rows(competitor_map(history, hot_rows=0)) == rows(plain)


def test_rank_matches_brute_force(history):
    data = [r for r in competitor_map(history, hot_rows=3).collect()]
    for r in data:
        cheaper = sum(
            1 for o in data
            if (o.parent_asin, o.scrape_date) == (r.parent_asin, r.scrape_date) and o.price < r.price
        )
        assert r.price_rank == cheaper + 1


def test_landscape(history):
    market = competitor_map(history)
    plain = rows(competitor_landscape(market, exact=True))
    spread = rows(competitor_landscape(market, exact=True, hot_rows=5))
    assert [r[:2] for r in plain] == [r[:2] for r in spread]
    for a, b in zip(plain, spread):
        assert a[2:] == pytest.approx(b[2:])


def test_serving_stats(spark, sf):
    rivals = B.bronze_competitors(spark, sf)
    assert rows(serving_price_stats(rivals)) == rows(serving_price_stats(rivals, hot_rows=1))


def test_rank_ties_leave_gaps(spark):
    df = spark.createDataFrame([("p", 1.0), ("p", 1.0), ("p", 2.0)], "k string, v double")
    assert sorted(r.r for r in rank_rows(df, ["k"], "v", "r").collect()) == [1, 1, 3]


def test_latest_is_independent_of_row_order(spark):
    data = [("a", 1, 5.0), ("a", 2, 7.0), ("a", 2, 6.0), ("b", 1, None)]
    schema = "k string, t int, v double"
    first = latest_per(spark.createDataFrame(data, schema), ["k"], "t", ["v"])
    second = latest_per(spark.createDataFrame(data[::-1], schema), ["k"], "t", ["v"])
    assert rows(first) == rows(second) == [("a", 2, 6.0), ("b", 1, None)]
