"""Keys, titles and stock texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import STOCK_RULES, StockRule

KEY_PATTERN = "^[A-Z0-9]{10}$"


# The characters stripped from both ends of keys and titles.
_BLANKS = " \t\n\r\f\v"


def strip(col: Column) -> Column:
    """Trim every kind of blank, not only spaces."""
    return F.trim(col, F.lit(_BLANKS))


def normalise_key(col: Column) -> Column:
    """Trimmed, upper-cased product key."""
    return F.upper(strip(col))


def valid_key(col: Column) -> Column:
    return col.rlike(KEY_PATTERN)


def clean_title(col: Column) -> Column:
    """Title text before the first dash, then before the first pipe."""
    return strip(F.split_part(F.split_part(col, F.lit("-"), F.lit(1)), F.lit("|"), F.lit(1)))


def product_url(domain: Column, asin: Column) -> Column:
    return F.concat(F.lit("https://www.amazon."), domain, F.lit("/dp/"), asin)


def _mentions(text: Column, phrases: Sequence[str]) -> Column:
    found = F.contains(text, F.lit(phrases[0]))
    for phrase in phrases[1:]:
        found = found | F.contains(text, F.lit(phrase))
    return found


def stock_level(col: Column, rules: Sequence[StockRule] = STOCK_RULES) -> Column:
    """First rule whose phrase occurs in the text; no text or no match is ``unknown``."""
    text = F.lower(col)
    level = F.when(_mentions(text, rules[0].phrases), rules[0].level)
    for rule in rules[1:]:
        level = level.when(_mentions(text, rule.phrases), rule.level)
    return level.otherwise("unknown")


def stock_signal(col: Column, compat: bool = False) -> Column:
    """Serving signal: struct(level, severity, action).

    "unavailable" anywhere in the text means out of stock, so that "Currently
    unavailable" is not read as available; ``compat`` accepts only the exact word.
    """

    def signal(level: str, severity: str, action: str | None) -> Column:
        return F.struct(
            F.lit(level).alias("level"),
            F.lit(severity).alias("severity"),
            F.lit(action).cast("string").alias("action"),
        )

    text = F.lower(strip(F.coalesce(col, F.lit(""))))
    if compat:
        gone = text.isin("", "none", "unavailable") | _mentions(text, ("out of stock",))
    else:
        gone = text.isin("", "none") | _mentions(text, ("out of stock", "unavailable"))
    # Levels, severities and the actions shown to the user.
    return (
        F.when(gone, signal("out_of_stock", "critical", "Restock immediately — product is unavailable."))
        .when(
            _mentions(text, ("limited", "only", "few")),
            signal("low_stock", "warning", "Consider restocking soon."),
        )
        .when(_mentions(text, ("in stock", "available")), signal("in_stock", "ok", None))
        .otherwise(signal("unknown", "info", "Verify stock status manually."))
    )
