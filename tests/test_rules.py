"""Literal cases of the pricing and stock rules."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from quotemill.functions import pricing
from quotemill.functions.binning import as_day, label_of, monday_zero, right_closed_index
from quotemill.functions.text import clean_title, normalise_key, stock_level, stock_signal, valid_key
from quotemill.operators.metrics import quality_gate, regression_metrics
from quotemill.operators.quality import require_columns, require_null_fraction, require_rows
from quotemill.operators.serving import serving_analysis, serving_price_stats
from quotemill.rules import DIFF_EDGES, DIFF_LABELS, STOCK_RULES_COMPAT


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


RIVAL = "parent_asin string, asin string, price double, rating double"


def rivals(spark, prices, ratings=None):
    ratings = ratings or [None] * len(prices)
    rows = [("P", f"C{i}", p, r) for i, (p, r) in enumerate(zip(prices, ratings))]
    return spark.createDataFrame(rows, RIVAL)


@pytest.mark.parametrize(
    "prices, expected",
    [
        ([10.0, 20.0, 30.0], (20.0, 20.0, 10.0, 30.0, 3)),
        ([10.0, None, 30.0], (20.0, 20.0, 10.0, 30.0, 2)),
        ([49.99], (49.99, 49.99, 49.99, 49.99, 1)),
        ([10.0, 20.0], (15.0, 15.0, 10.0, 20.0, 2)),
        ([None, None], None),
        ([], None),
    ],
)
def test_price_stats(spark, prices, expected):
    row = serving_price_stats(rivals(spark, prices)).first()
    assert (row and tuple(row)[1:]) == expected


def analysis(spark, price, prices, rating=None, ratings=None, stock="In Stock"):
    product = spark.createDataFrame(
        [("P", "t", price, None, rating, stock)],
        "asin string, title string, price double, currency string, rating double, stock string",
    )
    return serving_analysis(product, rivals(spark, prices, ratings)).first()


@pytest.mark.parametrize(
    "price, position",
    [(110.0, "above_market"), (100.0, "at_market"), (104.0, "at_market"), (80.0, "below_market"),
     (105.0, "at_market"), (95.0, "at_market")],
)
def test_position(spark, price, position):
    assert analysis(spark, price, [100.0]).suggestion.price_position == position


def test_discount(spark):
    assert analysis(spark, 120.0, [100.0]).suggestion.discount_pct == 16.7
    assert analysis(spark, 80.0, [100.0]).suggestion.discount_pct == 0.0


def test_premium(spark):
    plain = analysis(spark, 200.0, [100.0] * 3).suggestion.suggested_price
    assert analysis(spark, 200.0, [100.0] * 3, 4.8, [4.0] * 3).suggestion.suggested_price == 103.0 > plain
    assert analysis(spark, 200.0, [100.0] * 3, 4.2, [4.0] * 3).suggestion.suggested_price == plain
    assert analysis(spark, 100.0, [33.333]).suggestion.suggested_price == 33.33


def test_analysis_without_market_or_price(spark):
    row = analysis(spark, 100.0, [None], stock=None)
    assert row.price_stats is None and row.suggestion is None
    assert row.currency == "USD" and row.stock_signal.level == "out_of_stock"
    row = analysis(spark, None, [10.0])
    assert row.price_stats.median == 10.0 and row.suggestion is None


@pytest.mark.parametrize(
    "text, level, severity",
    [
        ("In Stock", "in_stock", "ok"),
        ("Usually ships within 24 hours, available now", "in_stock", "ok"),
        ("Out of Stock", "out_of_stock", "critical"),
        ("OUT OF STOCK", "out_of_stock", "critical"),
        (None, "out_of_stock", "critical"),
        ("  \t", "out_of_stock", "critical"),
        ("none", "out_of_stock", "critical"),
        ("Currently unavailable", "out_of_stock", "critical"),
        ("Only 3 left in stock – order soon", "low_stock", "warning"),
        ("Very few remaining", "low_stock", "warning"),
        ("Ships in 3-5 business days", "unknown", "info"),
    ],
)
def test_stock_signal(spark, text, level, severity):
    signal = value(spark, stock_signal(F.lit(text).cast("string")))
    assert (signal.level, signal.severity) == (level, severity)
    assert (signal.action is None) == (level == "in_stock")


def test_stock_signal_compat(spark):
    text = F.lit("Currently unavailable")
    assert value(spark, stock_signal(text, compat=True)).level == "in_stock"


@pytest.mark.parametrize(
    "text, intent, compat",
    [
        ("Only 3 left in stock", "low_stock", "in_stock"),
        ("Currently unavailable", "out_of_stock", "in_stock"),
        ("Limited availability", "low_stock", "low_stock"),
        ("Out of Stock", "out_of_stock", "out_of_stock"),
        ("", "unknown", "unknown"),
        (None, "unknown", "unknown"),
        ("soon", "unknown", "unknown"),
    ],
)
def test_stock_level(spark, text, intent, compat):
    col = F.lit(text).cast("string")
    assert value(spark, stock_level(col)) == intent
    assert value(spark, stock_level(col, STOCK_RULES_COMPAT)) == compat


def test_keys_and_titles(spark):
    assert value(spark, normalise_key(F.lit("\t b07abc1234 \n"))) == "B07ABC1234"
    assert value(spark, valid_key(F.lit("B07ABC1234"))) is True
    assert value(spark, valid_key(F.lit("B07"))) is False
    assert value(spark, clean_title(F.lit("Lamp | Desk - Large | New"))) == "Lamp"
    assert value(spark, clean_title(F.lit("Plain"))) == "Plain"


def test_price_guards(spark):
    zero, ten = F.lit(0.0), F.lit(10.0)
    assert value(spark, pricing.pct_of(ten, zero)) is None
    assert value(spark, pricing.momentum(ten, zero)) is None
    assert value(spark, pricing.ratio(ten, zero)) is None
    assert value(spark, pricing.pressure(F.lit(1), F.lit(0))) is None
    assert value(spark, pricing.price_position(ten, F.lit(None).cast("double"))) is None
    assert value(spark, pricing.money(F.lit(2.675))) == 2.68
    # 4.3 - 4.0 is 0.2999… in binary and must not count as more than 0.3
    assert value(spark, pricing.rating_premium(F.lit(4.3), F.lit(4.0))) == 0.0
    assert value(spark, pricing.rating_premium(F.lit(4.31), F.lit(4.0))) == 0.03


def test_bins_are_right_closed(spark):
    def label(x):
        return value(spark, label_of(right_closed_index(F.lit(x), DIFF_EDGES), DIFF_LABELS))

    assert [label(x) for x in (-100.0, -99.9, -20.0, 0.0, 0.1, 100.0, 100.1)] == [
        None, "<-20%", "<-20%", "-5→0%", "0→5%", ">20%", None,
    ]


def test_calendar(spark):
    assert value(spark, monday_zero(F.lit(date(2024, 1, 1)))) == 0
    assert as_day("2024-02-03") == date(2024, 2, 3)
    assert as_day("").year >= 2024


def metrics_row(spark, pairs):
    df = spark.createDataFrame(pairs, "y double, p double")
    return regression_metrics(df, "y", "p").first()


def test_metrics(spark):
    row = metrics_row(spark, [(1.0, 1.0), (2.0, 2.0)])
    assert (row.rmse, row.mae, row.mape) == (0.0, 0.0, 0.0)
    row = metrics_row(spark, [(50.0, 55.0), (100.0, 90.0), (200.0, 210.0)])
    assert row.rmse == pytest.approx(75**0.5) and row.mape == pytest.approx(25 / 3)
    row = metrics_row(spark, [(0.0, 5.0), (100.0, 90.0)])
    assert row.mape == pytest.approx(10.0) and row.mae == 7.5


@pytest.mark.parametrize(
    "rmse, mape, limits, passed, word",
    [
        (1.5, 3.0, (5.0, 10.0), True, "All"),
        (10.0, 3.0, (5.0, 10.0), False, "RMSE"),
        (1.0, 25.0, (5.0, 15.0), False, "MAPE"),
        (99.0, 99.0, (None, None), True, "All"),
        (99.0, 99.0, (5.0, 5.0), False, "RMSE"),
    ],
)
def test_gate(spark, rmse, mape, limits, passed, word):
    df = spark.createDataFrame([(rmse, mape)], "rmse double, mape double")
    row = quality_gate(df, *limits).first()
    assert row.passed is passed and row.message.startswith(word)


def test_requirements(spark):
    df = spark.createDataFrame([(1.0,), (None,), (None,), (None,)], "a double")
    with pytest.raises(ValueError, match="Missing"):
        require_columns(df, ["a", "b"])
    with pytest.raises(ValueError, match="Only 4 rows"):
        require_rows(df, 10)
    require_rows(df, 4)
    with pytest.raises(ValueError, match="nulls"):
        require_null_fraction(df, ["a"])
    require_null_fraction(df, ["a"], 0.8)
