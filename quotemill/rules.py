"""Business constants and rule tables."""

from __future__ import annotations

from dataclasses import dataclass

# Feature names, target and thresholds that results depend on.
FEATURE_COLUMNS = [
    "current_price",
    "price_7d_ma",
    "price_7d_volatility",
    "price_momentum",
    "comp_median_price",
    "comp_avg_price",
    "comp_min_price",
    "comp_max_price",
    "comp_count",
    "competitors_below",
    "comp_pressure_score",
]
ENGINEERED_COLUMNS = ["day_of_week", "price_to_median_ratio"]
MODEL_COLUMNS = FEATURE_COLUMNS + ENGINEERED_COLUMNS
TARGET_COLUMN = "suggested_price"
SEQUENCE_COLUMNS = ["current_price", "comp_median_price", "comp_pressure_score"]

# Bin edges and labels.
DIFF_EDGES = [-100.0, -20.0, -10.0, -5.0, 0.0, 5.0, 10.0, 20.0, 100.0]
DIFF_LABELS = ["<-20%", "-20→-10%", "-10→-5%", "-5→0%", "0→5%", "5→10%", "10→20%", ">20%"]
RATING_EDGES = [0.0, 3.0, 3.5, 4.0, 4.5, 5.0]
RATING_LABELS = ["<3.0", "3.0-3.5", "3.5-4.0", "4.0-4.5", "4.5-5.0"]
TERCILE_LABELS = ["low", "mid", "high"]

# Gradient-boosting defaults and the search grid.
GBT_DEFAULTS = {
    "n_estimators": 200,
    "max_depth": 4,
    "learning_rate": 0.05,
    "subsample": 0.8,
    "colsample": 0.8,
    "seed": 42,
}
SEARCH_SPACE = {
    "n_estimators": [100, 200, 300, 500],
    "max_depth": [3, 4, 5, 6],
    "learning_rate": [0.01, 0.05, 0.1, 0.2],
    "subsample": [0.7, 0.8, 0.9, 1.0],
    "colsample": [0.6, 0.7, 0.8, 1.0],
}
# Tree counts and depths of the sensitivity study.
SWEPT_TREES = (50, 100, 200, 300, 500)
SWEPT_DEPTHS = (2, 3, 4, 5, 6, 8)


# Parameters of the price rules.
@dataclass(frozen=True)
class PriceRules:
    """Parameters of the gold layer."""

    window_rows: int = 7
    lag_rows: int = 7
    rating_threshold: float = 0.3
    rating_premium: float = 0.03
    position_band: float = 0.05


@dataclass(frozen=True)
class StockRule:
    """``level`` applies when the lower-cased text contains any of ``phrases``."""

    level: str
    phrases: tuple[str, ...]


# Stock levels and the phrases that name them.
# Scarcity and absence are tested before plain availability, because "unavailable"
# contains "available" and "Only 3 left in stock" contains "in stock".
STOCK_RULES = (
    StockRule("out_of_stock", ("out of stock", "out_of_stock", "unavailable")),
    StockRule("low_stock", ("limited", "low stock", "low_stock", "only")),
    StockRule("in_stock", ("in stock", "in_stock", "available")),
)

# Compatibility order: availability first, which labels both phrases above in_stock.
STOCK_RULES_COMPAT = tuple(reversed(STOCK_RULES))

RULES = PriceRules()

# A group with more rows than this leaves the one-task-per-group plan for the
# distributed one. At most rows / HOT_GROUP_ROWS groups can exceed it.
HOT_GROUP_ROWS = 1_000_000

# Frames with one row per hot group are broadcast only up to this counted size.
BROADCAST_ROWS = 100_000
