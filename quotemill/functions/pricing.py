"""Price arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import RULES, PriceRules


def settle(col: Column) -> Column:
    """Drop binary noise beyond six digits before a comparison with a threshold."""
    return F.round(col, 6)


def money(col: Column) -> Column:
    """Two digits, halves up; noise is removed first so that ties are real ties."""
    return F.round(settle(col), 2)


def rounded(col: Column, digits: int) -> Column:
    """Halves up at ``digits``, after dropping noise that would unsettle exact halves."""
    return F.round(F.round(col, 9), digits)


def pct_of(part: Column, base: Column) -> Column:
    """``part / base * 100``; null unless the base is positive."""
    return F.when(base > 0, part / base * 100)


def momentum(price: Column, earlier: Column) -> Column:
    return F.when(earlier > 0, (price - earlier) / earlier)


def pressure(below: Column, count: Column) -> Column:
    return F.when(count > 0, below.cast("double") / count)


def rating_premium(rating: Column, market: Column, rules: PriceRules = RULES) -> Column:
    earned = settle(rating - market) > rules.rating_threshold
    return F.when(earned, F.lit(rules.rating_premium)).otherwise(F.lit(0.0))


def suggested_price(median: Column, premium: Column) -> Column:
    return money(median * (1 + premium))


def price_position(price: Column, median: Column, band: float = RULES.position_band) -> Column:
    return (
        F.when(settle(price - median * (1 + band)) > 0, "above_market")
        .when(settle(price - median * (1 - band)) < 0, "below_market")
        .when(median.isNotNull(), "at_market")
    )


def discount_pct(price: Column, suggested: Column) -> Column:
    cut = F.round(settle((price - suggested) / F.nullif(price, F.lit(0.0)) * 100), 1)
    return F.greatest(F.lit(0.0), cut)


def ratio(part: Column, base: Column) -> Column:
    """Division that is null for a zero base."""
    return part / F.nullif(base, F.lit(0.0))
