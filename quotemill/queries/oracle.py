"""SQL text shared by the oracle queries (DuckDB dialect, plain SELECTs)."""

from __future__ import annotations

from .binding import SNAPSHOT


def decimals(expr: str, digits: int) -> str:
    """Rounding on the decimal value, halves away from zero, so that exact halves agree."""
    return f"(CAST(round(CAST(round({expr}, 9) AS DECIMAL(28, 9)), {digits}) AS DOUBLE) + 0.0)"


def r6(expr: str) -> str:
    return decimals(expr, 6)


def money(expr: str) -> str:
    """Two digits after dropping noise beyond six."""
    return f"CAST(round(CAST(round({expr}, 6) AS DECIMAL(18, 6)), 2) AS DOUBLE)"


STOCK_LEVEL = """CASE
  WHEN contains(lower(stock), 'out of stock') OR contains(lower(stock), 'unavailable') THEN 'out_of_stock'
  WHEN contains(lower(stock), 'limited') OR contains(lower(stock), 'low stock') OR contains(lower(stock), 'only') THEN 'low_stock'
  WHEN contains(lower(stock), 'in stock') OR contains(lower(stock), 'available') THEN 'in_stock'
  ELSE 'unknown' END"""

_BRONZE = ", ".join(f"{expr.replace('STRING', 'VARCHAR')} AS {name}" for name, expr in SNAPSHOT.items())

CTES = {
    "obs": f"SELECT user_id % 10 = 0 AS own, CAST(ts AS DATE) AS scrape_date, event_id, {_BRONZE} FROM events",
    "bp": "SELECT asin, title, brand, price, currency, stock, rating, seen_at AS scraped_at, scrape_date FROM obs WHERE own",
    "bc": "SELECT parent_asin, asin, title, brand, price, currency, rating, seen_at AS fetched_at, scrape_date FROM obs WHERE NOT own",
    "sp": f"""SELECT asin, price, coalesce(currency, 'USD') AS currency, {STOCK_LEVEL} AS stock, rating,
  'product' AS source, CAST(NULL AS VARCHAR) AS parent_asin, scrape_date, scraped_at
  FROM bp WHERE price > 0
  QUALIFY row_number() OVER (PARTITION BY asin, scrape_date ORDER BY scraped_at DESC, price) = 1""",
    "sc": """SELECT asin, price, coalesce(currency, 'USD') AS currency, 'unknown' AS stock, rating,
  'competitor' AS source, parent_asin, scrape_date, fetched_at AS scraped_at
  FROM bc WHERE price > 0
  QUALIFY row_number() OVER (PARTITION BY asin, parent_asin, scrape_date ORDER BY fetched_at DESC, price) = 1""",
    "silver": "SELECT * FROM sp UNION ALL SELECT * FROM sc",
    "cmap": """SELECT c.parent_asin, c.asin, c.price, c.currency, c.rating,
  CASE WHEN p.price > 0 THEN (c.price - p.price) / p.price * 100 END AS price_diff_pct, p.price AS own_price,
  CAST(rank() OVER (PARTITION BY c.parent_asin, c.scrape_date ORDER BY c.price) AS INTEGER) AS price_rank,
  c.scrape_date
  FROM sc c LEFT JOIN sp p ON p.asin = c.parent_asin AND p.scrape_date = c.scrape_date""",
    "roll": """SELECT asin, scrape_date, price, rating, currency, stock,
  avg(price) OVER (PARTITION BY asin ORDER BY scrape_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma,
  stddev_samp(price) OVER (PARTITION BY asin ORDER BY scrape_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS vol,
  (price - lag(price, 7) OVER (PARTITION BY asin ORDER BY scrape_date))
    / nullif(lag(price, 7) OVER (PARTITION BY asin ORDER BY scrape_date), 0) AS mom
  FROM sp""",
}


def landscape(median: str) -> str:
    return f"""SELECT parent_asin AS asin, scrape_date, {median} AS med, avg(price) AS avg_price,
  min(price) AS min_price, max(price) AS max_price, CAST(count(*) AS INTEGER) AS n, avg(rating) AS avg_rating,
  CAST(sum(CASE WHEN price < own_price THEN 1 WHEN own_price IS NULL THEN NULL ELSE 0 END) AS INTEGER) AS below
  FROM cmap GROUP BY parent_asin, scrape_date"""


GOLD = f"""SELECT r.asin, r.scrape_date, r.price AS current_price, r.currency, r.ma AS price_7d_ma,
  r.vol AS price_7d_volatility, r.mom AS price_momentum, l.med AS comp_median_price, l.avg_price AS comp_avg_price,
  l.min_price AS comp_min_price, l.max_price AS comp_max_price, l.n AS comp_count, l.below AS competitors_below,
  CAST(l.below AS DOUBLE) / nullif(l.n, 0) AS comp_pressure_score,
  {money("l.med * (CASE WHEN round(r.rating - l.avg_rating, 6) > CAST(0.3 AS DOUBLE) THEN CAST(1.03 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END)")} AS suggested_price,
  CASE WHEN round(r.price - l.med * CAST(1.05 AS DOUBLE), 6) > 0 THEN 'above_market'
       WHEN round(r.price - l.med * CAST(0.95 AS DOUBLE), 6) < 0 THEN 'below_market'
       WHEN l.med IS NOT NULL THEN 'at_market' END AS price_position
  FROM roll r LEFT JOIN {{land}} l ON l.asin = r.asin AND l.scrape_date = r.scrape_date"""

CTES["land"] = landscape("quantile_disc(price, 0.5)")
CTES["gold"] = GOLD.format(land="land")
CTES["land_exact"] = landscape("median(price)")
CTES["gold_exact"] = GOLD.format(land="land_exact")
CTES["pred"] = """SELECT asin, scrape_date, comp_median_price AS predicted_price, current_price,
  (comp_median_price - current_price) / nullif(current_price, 0) * 100 AS price_diff_pct, 'naive' AS model_version
  FROM gold WHERE comp_median_price IS NOT NULL"""

# Numeric columns of the feature table.
_GOLD_NUMBERS = [
    "current_price",
    "price_7d_ma",
    "price_7d_volatility",
    "price_momentum",
    "comp_median_price",
    "comp_avg_price",
    "comp_min_price",
    "comp_max_price",
    "comp_pressure_score",
    "suggested_price",
]
GOLD_COLUMNS = ", ".join(
    ["asin", "CAST(scrape_date AS VARCHAR) AS scrape_date", "currency", "price_position", "comp_count", "competitors_below"]
    + [f"{r6(c)} AS {c}" for c in _GOLD_NUMBERS]
)


def chain(select: str, **extra: str) -> str:
    """The whole layer chain, optional further CTEs, then ``select``."""
    steps = {**CTES, **extra}
    body = ",\n".join(f"{name} AS ({text})" for name, text in steps.items())
    return f"WITH {body}\n{select}"


def describe_sql(source: str, column: str, label: str, group: str | None = None) -> str:
    """SELECT matching ``profile.describe`` for one column."""
    name, key = ("feature", f"'{label}'") if group is None else (group, group)
    tail = f" GROUP BY {group}" if group else ""
    x = f"CAST({column} AS DOUBLE)"
    return (
        f"SELECT {key} AS {name}, count({x}) AS count, {r6(f'avg({x})')} AS mean, "
        f"{r6(f'stddev_samp({x})')} AS std, {r6(f'min({x})')} AS min, "
        f"{r6(f'quantile_cont({x}, 0.25)')} AS p25, {r6(f'quantile_cont({x}, 0.5)')} AS p50, "
        f"{r6(f'quantile_cont({x}, 0.75)')} AS p75, {r6(f'max({x})')} AS max FROM {source}{tail}"
    )
