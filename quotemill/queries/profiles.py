"""Profiling queries."""

from __future__ import annotations

from itertools import combinations

from ..operators import profile as P
from ..operators.features import with_min_history
from ..operators.gold import own_prices, window_comparison
from ..operators.silver import competitor_map
from ..rules import DIFF_EDGES, DIFF_LABELS, FEATURE_COLUMNS, RATING_EDGES, RATING_LABELS
from . import binding as B
from .oracle import chain, decimals, describe_sql, r6
from .registry import query

_DATE = "CAST(scrape_date AS VARCHAR) AS scrape_date"


def _bins(column: str, edges: list[float]) -> str:
    """CASE giving the zero-based right-closed bin."""
    arms = " ".join(f"WHEN {column} <= {upper} THEN {i}" for i, upper in enumerate(edges[1:]))
    return f"CASE WHEN {column} <= {edges[0]} THEN NULL {arms} END"


def _labels(labels: list[str]) -> str:
    return "CASE bin " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(labels)) + " END"


@query("rows_per_day", chain(f"SELECT {_DATE}, count(*) AS rows, count(DISTINCT asin) AS unique_asin FROM bp GROUP BY scrape_date"))
def rows_per_day(spark, sf):
    return P.rows_per_day(B.bronze_products(spark, sf), "scraped_at", ["asin"])


@query(
    "competitor_rows_per_day",
    chain(f"SELECT {_DATE}, count(*) AS rows, count(DISTINCT parent_asin) AS unique_parent_asin FROM bc GROUP BY scrape_date"),
)
def competitor_rows_per_day(spark, sf):
    return P.rows_per_day(B.bronze_competitors(spark, sf), "fetched_at", ["parent_asin"])


@query(
    "rows_by_source",
    chain("SELECT source, count(*) AS rows, count(DISTINCT asin) AS unique_asins FROM silver GROUP BY source"),
)
def rows_by_source(spark, sf):
    return P.rows_by_source(B.price_history(spark, sf))


_COVER = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS total_rows, count(DISTINCT {key}) AS unique_keys, {second} AS unique_parents, "
    f"CAST(min(scrape_date) AS VARCHAR) AS earliest, CAST(max(scrape_date) AS VARCHAR) AS latest FROM {src}"
    for name, src, key, second in [
        ("bronze.products", "bp", "asin", "CAST(NULL AS BIGINT)"),
        ("bronze.competitors", "bc", "asin", "count(DISTINCT parent_asin)"),
        ("silver.price_history", "silver", "asin", "count(DISTINCT parent_asin)"),
        ("silver.competitor_map", "cmap", "asin", "count(DISTINCT parent_asin)"),
        ("gold.price_features", "gold", "asin", "CAST(NULL AS BIGINT)"),
    ]
)


@query("layer_coverage", chain(_COVER))
def layer_coverage(spark, sf):
    history = B.stored_history(spark, sf)
    parts = [
        P.coverage(B.bronze_products(spark, sf), "bronze.products", "asin", "scraped_at"),
        P.coverage(B.bronze_competitors(spark, sf), "bronze.competitors", "asin", "fetched_at", "parent_asin"),
        P.coverage(history, "silver.price_history", "asin", "scrape_date", "parent_asin"),
        P.coverage(competitor_map(history), "silver.competitor_map", "asin", "scrape_date", "parent_asin"),
        P.coverage(B.gold(spark, sf), "gold.price_features", "asin", "scrape_date"),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def _null_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column, count(*) - count({c}) AS null_count, "
        f"{decimals(f'(count(*) - count({c})) * CAST(100 AS DOUBLE) / count(*)', 1)} AS null_pct, "
        f"{decimals(f'(count(*) - count({c})) * CAST(100 AS DOUBLE) / count(*)', 1)} > 10 AS flagged FROM {source}"
        for c in columns
    )


@query("null_rates", chain(_null_sql("bp", ["asin", "title", "brand", "price", "currency", "stock", "rating", "scraped_at"])))
def null_rates(spark, sf):
    return P.null_rates(B.bronze_products(spark, sf))


_GOLD_NULLS = FEATURE_COLUMNS + ["suggested_price"]


@query("gold_null_rates", chain(_null_sql("gold", _GOLD_NULLS)))
def gold_null_rates(spark, sf):
    return P.null_rates(B.gold(spark, sf), _GOLD_NULLS)


def _share_sql(source: str, column: str) -> str:
    pct = decimals("count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER ()", 1)
    return f"SELECT {column}, count(*) AS rows, {pct} AS pct FROM {source} GROUP BY {column}"


@query("stock_share", chain(_share_sql("sp", "stock")))
def stock_share(spark, sf):
    return P.category_share(B.own_history(spark, sf), "stock")


@query("position_share", chain(_share_sql("gold", "price_position")))
def position_share(spark, sf):
    return P.category_share(B.gold(spark, sf), "price_position")


@query(
    "history_depth",
    chain("SELECT asin, count(*) AS days_of_history, count(*) >= 7 AS qualified FROM gold GROUP BY asin"),
)
def history_depth(spark, sf):
    return P.history_depth(B.gold(spark, sf))


@query(
    "min_history",
    chain(f"SELECT asin, {_DATE}, {r6('current_price')} AS current_price FROM gold QUALIFY count(*) OVER (PARTITION BY asin) >= 7"),
)
def min_history(spark, sf):
    return with_min_history(B.gold(spark, sf)).select("asin", "scrape_date", "current_price")


@query(
    "feature_table_profile",
    chain(
        "SELECT CAST(sum(rows) AS BIGINT) AS total_rows, count(DISTINCT asin) AS unique_asins, "
        "CAST(min(scrape_date) AS VARCHAR) AS earliest, CAST(max(scrape_date) AS VARCHAR) AS latest, "
        "count(*) FILTER (WHERE rows > 1) AS repeated_keys "
        "FROM (SELECT asin, scrape_date, count(*) AS rows FROM gold GROUP BY asin, scrape_date)"
    ),
)
def feature_table_profile(spark, sf):
    return P.feature_table_profile(B.gold(spark, sf))


@query(
    "latest_feature_rows",
    chain(
        f"SELECT asin, {_DATE}, {r6('current_price')} AS current_price, suggested_price, price_position, comp_count, "
        f"{decimals('comp_pressure_score', 3)} AS pressure FROM gold ORDER BY gold.scrape_date DESC, asin LIMIT 10"
    ),
)
def latest_feature_rows(spark, sf):
    return P.latest_rows(B.gold(spark, sf))


@query("price_describe", chain(describe_sql("sp", "price", "price")))
def price_describe(spark, sf):
    return P.describe(B.own_history(spark, sf), ["price"])


_DESCRIBED = ["price_7d_volatility", "price_momentum"] + ["current_price", "comp_count"]


@query("feature_describe", chain(" UNION ALL ".join(describe_sql("gold", c, c) for c in _DESCRIBED)))
def feature_describe(spark, sf):
    return P.describe(B.stored_gold(spark, sf), _DESCRIBED)


@query("price_diff_describe", chain(describe_sql("cmap", "price_diff_pct", "price_diff_pct")))
def price_diff_describe(spark, sf):
    return P.describe(B.stored_rivals(spark, sf), ["price_diff_pct"])


@query(
    "price_percentiles",
    chain("SELECT " + ", ".join(f"{r6(f'quantile_cont(price, {p / 100})')} AS p{p}" for p in (5, 25, 50, 75, 90, 95, 99)) + " FROM sp"),
)
def price_percentiles(spark, sf):
    return P.price_percentiles(B.own_history(spark, sf))


@query(
    "price_stats_per_key",
    chain(
        f"SELECT asin, count(*) AS days, {r6('min(price)')} AS min_price, {r6('max(price)')} AS max_price, "
        f"{r6('stddev_samp(price)')} AS std, {r6('stddev_samp(price) / nullif(avg(price), 0)')} AS cv FROM sp GROUP BY asin"
    ),
)
def price_stats_per_key(spark, sf):
    return P.price_stats_per_key(B.own_history(spark, sf))


@query(
    "dow_seasonality",
    chain(
        f"SELECT dow, day, {r6('median_price')} AS median_price, {r6('mean_price')} AS mean_price, {r6('std')} AS std, count, "
        f"{r6('vs')} AS vs_avg_pct, {r6('max(vs) OVER () - min(vs) OVER ()')} AS spread_pct FROM "
        "(SELECT *, (mean_price - overall) / overall * 100 AS vs FROM (SELECT CAST(isodow(scrape_date) - 1 AS INTEGER) AS dow, "
        "dayname(scrape_date) AS day, median(price) AS median_price, avg(price) AS mean_price, stddev_samp(price) AS std, "
        "count(price) AS count, (SELECT avg(price) FROM sp) AS overall FROM sp GROUP BY 1, 2))"
    ),
)
def dow_seasonality(spark, sf):
    return P.dow_seasonality(B.own_history(spark, sf))


@query(
    "volatility_ranking",
    chain(f"SELECT asin, {r6('avg(price_7d_volatility)')} AS mean_volatility, count(*) AS rows FROM gold WHERE price_7d_volatility IS NOT NULL GROUP BY asin"),
)
def volatility_ranking(spark, sf):
    return P.volatility_ranking(B.gold(spark, sf))


@query(
    "momentum_exceedance",
    chain(
        "SELECT count(*) AS rows, "
        + ", ".join(
            f"{r6(f'avg(CASE WHEN round(abs(price_momentum), 6) > CAST({t} AS DOUBLE) THEN 1.0 ELSE 0.0 END)')} AS over_{round(t * 100)}pct"
            for t in (0.05, 0.10, 0.20)
        )
        + " FROM gold WHERE price_momentum IS NOT NULL"
    ),
)
def momentum_exceedance(spark, sf):
    return P.momentum_exceedance(B.gold(spark, sf))


@query(
    "rank_distribution",
    chain("SELECT price_rank, count(*) AS competitors FROM cmap GROUP BY price_rank ORDER BY price_rank LIMIT 10"),
)
def rank_distribution(spark, sf):
    return P.rank_distribution(B.rivals(spark, sf))


@query(
    "rank_summary",
    chain(f"SELECT parent_asin, {r6('avg(price_rank)')} AS avg_rank, min(price_rank) AS min_rank, max(price_rank) AS max_rank FROM cmap GROUP BY parent_asin"),
)
def rank_summary(spark, sf):
    return P.rank_summary(B.rivals(spark, sf))


def _profiled(column: str, per_day: str) -> str:
    total = describe_sql("per_day", column, "(all)").replace("AS feature", "AS parent_asin")
    return chain(
        describe_sql("per_day", column, "", group="parent_asin") + " UNION ALL " + total, per_day=per_day
    )


@query(
    "competitor_count_profile",
    _profiled("comp_count", "SELECT parent_asin, scrape_date, count(asin) AS comp_count FROM cmap GROUP BY parent_asin, scrape_date"),
)
def competitor_count_profile(spark, sf):
    return P.competitor_count_profile(B.rivals(spark, sf))


_SPREAD = (
    "SELECT parent_asin, scrape_date, (max(price) - min(price)) * 100 / nullif(median(price), 0) AS spread_pct, "
    "abs(median(price) - avg(price)) * 100 / nullif(median(price), 0) AS median_vs_mean_pct "
    "FROM cmap GROUP BY parent_asin, scrape_date"
)


@query("price_spread", _profiled("spread_pct", _SPREAD))
def price_spread(spark, sf):
    return P.price_spread(B.stored_rivals(spark, sf))


@query(
    "daily_spread",
    chain(f"SELECT parent_asin, {_DATE}, {r6('spread_pct')} AS spread_pct, {r6('median_vs_mean_pct')} AS median_vs_mean_pct FROM per_day", per_day=_SPREAD),
)
def daily_spread(spark, sf):
    return P.daily_spread(B.stored_rivals(spark, sf))


@query(
    "diff_histogram",
    chain(
        f"SELECT bin, {_labels(DIFF_LABELS)} AS diff_bucket, rows, {decimals('rows * CAST(100 AS DOUBLE) / sum(rows) OVER ()', 1)} AS pct "
        f"FROM (SELECT {_bins('round(price_diff_pct, 6)', DIFF_EDGES)} AS bin, count(*) AS rows FROM cmap GROUP BY 1) WHERE bin IS NOT NULL"
    ),
)
def diff_histogram(spark, sf):
    return P.diff_histogram(B.rivals(spark, sf))


@query(
    "rating_price_corr",
    chain(f"SELECT {r6('corr(rating, price)')} AS correlation, count(*) AS rows FROM cmap WHERE rating IS NOT NULL AND price IS NOT NULL"),
)
def rating_price_corr(spark, sf):
    return P.rating_price_correlation(B.rivals(spark, sf))


@query(
    "rating_buckets",
    chain(
        f"SELECT bin, {_labels(RATING_LABELS)} AS rating_bucket, {r6('avg(price)')} AS mean_price, {r6('median(price)')} AS median_price, "
        f"count(price) AS count FROM (SELECT {_bins('rating', RATING_EDGES)} AS bin, price FROM cmap WHERE rating IS NOT NULL) "
        "WHERE bin IS NOT NULL GROUP BY bin"
    ),
)
def rating_buckets(spark, sf):
    return P.rating_buckets(B.stored_rivals(spark, sf))


_STABLE = (
    "SELECT parent_asin, asin, avg(price_rank) AS avg_rank, stddev_samp(price_rank) AS rank_std, "
    "count(price_rank) AS days_seen FROM cmap GROUP BY parent_asin, asin"
)


@query("rank_stability", chain(f"SELECT parent_asin, asin, {r6('avg_rank')} AS avg_rank, {r6('rank_std')} AS rank_std, days_seen FROM s", s=_STABLE))
def rank_stability(spark, sf):
    return P.rank_stability(B.rivals(spark, sf))


@query("mean_rank_deviation", chain(f"SELECT {r6('avg(rank_std)')} AS avg_rank_std, count(*) AS rows FROM s", s=_STABLE))
def mean_rank_deviation(spark, sf):
    return P.mean_rank_deviation(B.rivals(spark, sf))


def _flag(condition: str) -> str:
    return r6(f"avg(CASE WHEN {condition} THEN 1.0 ELSE 0.0 END)")


_SCORE = "round(comp_pressure_score, 6)"


@query(
    "pressure_bands",
    chain(
        f"SELECT * FROM ({describe_sql('gold', 'comp_pressure_score', 'comp_pressure_score')}) CROSS JOIN "
        f"(SELECT {_flag(f'{_SCORE} > CAST(0.7 AS DOUBLE)')} AS above_share, "
        f"{_flag(f'{_SCORE} BETWEEN CAST(0.3 AS DOUBLE) AND CAST(0.7 AS DOUBLE)')} AS at_share, "
        f"{_flag(f'{_SCORE} < CAST(0.3 AS DOUBLE)')} AS below_share FROM gold WHERE comp_pressure_score IS NOT NULL)"
    ),
)
def pressure_bands(spark, sf):
    return P.pressure_bands(B.stored_gold(spark, sf))


@query(
    "window_sensitivity",
    chain(
        f"SELECT {r6('corr(price, m3)')} AS ma_3d, {r6('corr(price, m7)')} AS ma_7d, {r6('corr(price, m14)')} AS ma_14d FROM (SELECT price, "
        + ", ".join(
            f"avg(price) OVER (PARTITION BY asin ORDER BY scrape_date ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW) AS m{w}" for w in (3, 7, 14)
        )
        + " FROM sp)"
    ),
)
def window_sensitivity(spark, sf):
    return P.window_sensitivity(B.own_history(spark, sf))


@query(
    "window_comparison",
    chain(
        f"SELECT asin, {_DATE}, {r6('price')} AS price, "
        + ", ".join(
            f"{r6(f'{fn}(price) OVER (PARTITION BY asin ORDER BY sp.scrape_date ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)')} AS {short}_{w}d"
            for w in (3, 7, 14)
            for fn, short in (("avg", "ma"), ("stddev_samp", "vol"))
        )
        + " FROM sp"
    ),
)
def window_comparison_query(spark, sf):
    return window_comparison(B.own_history(spark, sf))


def _band(b: float) -> str:
    above = f"avg(CASE WHEN round(current_price - comp_median_price * (1 + CAST({b} AS DOUBLE)), 6) > 0 THEN 1.0 ELSE 0.0 END)"
    below = f"avg(CASE WHEN round(current_price - comp_median_price * (1 - CAST({b} AS DOUBLE)), 6) < 0 THEN 1.0 ELSE 0.0 END)"
    return (
        f"SELECT CAST({b} AS DOUBLE) AS band, {r6(above)} AS above, {r6(f'1 - {above} - {below}')} AS at, {r6(below)} AS below "
        "FROM gold WHERE current_price IS NOT NULL AND comp_median_price IS NOT NULL"
    )


@query("band_sensitivity", chain(" UNION ALL ".join(_band(b) for b in (0.03, 0.05, 0.10))))
def band_sensitivity(spark, sf):
    return P.band_sensitivity(B.gold(spark, sf))


@query(
    "premium_sensitivity",
    chain(
        " UNION ALL ".join(
            f"SELECT CAST({t} AS DOUBLE) AS threshold, {_flag(f'round(o.r - c.r, 6) > CAST({t} AS DOUBLE)')} AS share FROM "
            "(SELECT asin, avg(rating) AS r FROM sp WHERE rating IS NOT NULL GROUP BY asin) o JOIN "
            "(SELECT parent_asin AS asin, avg(rating) AS r FROM cmap GROUP BY parent_asin) c ON o.asin = c.asin"
            for t in (0.1, 0.2, 0.3, 0.5, 1.0)
        )
    ),
)
def premium_sensitivity(spark, sf):
    history = B.stored_history(spark, sf)
    return P.premium_sensitivity(history, competitor_map(history))


_COMPLETE = "SELECT * FROM gold WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_COLUMNS)


@query(
    "feature_correlation",
    chain(
        " UNION ALL ".join(
            f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {r6(f'corr({a}, {b})')} AS r FROM complete"
            for a, b in combinations(FEATURE_COLUMNS, 2)
        ),
        complete=_COMPLETE,
    ),
)
def feature_correlation(spark, sf):
    return P.feature_correlation(B.gold(spark, sf))


@query(
    "correlated_pairs",
    chain(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {r6(f'corr({a}, {b})')} AS r FROM complete"
            for a, b in combinations(FEATURE_COLUMNS, 2)
        )
        + ") WHERE abs(r) > CAST(0.8 AS DOUBLE)",
        complete=_COMPLETE,
    ),
)
def correlated_pairs(spark, sf):
    return P.correlated_pairs(B.gold(spark, sf))


_DELTA = {
    "delta": "SELECT suggested_price - current_price AS price_delta, (suggested_price - current_price) / nullif(current_price, 0) * 100 AS delta_pct "
    "FROM gold WHERE suggested_price IS NOT NULL AND current_price IS NOT NULL"
}


@query(
    "target_delta",
    chain(
        f"SELECT * FROM ({describe_sql('delta', 'price_delta', 'price_delta')} UNION ALL {describe_sql('delta', 'delta_pct', 'delta_pct')}) CROSS JOIN "
        f"(SELECT {_flag('round(delta_pct, 6) > 1')} AS raise_share, {_flag('round(abs(delta_pct), 6) <= 1')} AS hold_share, "
        f"{_flag('round(delta_pct, 6) < -1')} AS cut_share FROM delta)",
        **_DELTA,
    ),
)
def target_delta(spark, sf):
    return P.target_delta(B.stored_gold(spark, sf))
