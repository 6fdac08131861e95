"""Silver, gold, serving and upsert queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import clean_title, normalise_key, stock_level, stock_signal, valid_key
from ..operators import gold as G
from ..operators import serving as V
from ..operators.features import point_in_time
from ..operators.merge import duplicate_keys, merge_rows
from ..operators.ordered import last_rows_per
from ..operators.quality import quality_report
from ..operators.silver import clean_competitors, clean_products, competitor_map
from ..session import stored
from . import binding as B
from .oracle import GOLD_COLUMNS, STOCK_LEVEL, chain, decimals, money, r6
from .registry import query

_DATE = "CAST(scrape_date AS VARCHAR) AS scrape_date"
_SILVER = f"asin, {r6('price')} AS price, currency, stock, {r6('rating')} AS rating, source, parent_asin, {_DATE}"


def _silver_columns(df):
    return df.drop("scraped_at")


@query("silver_products", chain(f"SELECT {_SILVER} FROM sp"))
def silver_products(spark, sf):
    return _silver_columns(clean_products(B.bronze_products(spark, sf)))


@query("silver_competitors", chain(f"SELECT {_SILVER} FROM sc"))
def silver_competitors(spark, sf):
    return _silver_columns(clean_competitors(B.bronze_competitors(spark, sf)))


@query("silver_price_history", chain(f"SELECT {_SILVER} FROM silver"))
def silver_price_history(spark, sf):
    return _silver_columns(B.price_history(spark, sf))


@query(
    "silver_union",
    chain("SELECT source, count(*) AS rows, count(DISTINCT asin) AS keys FROM silver GROUP BY source"),
)
def silver_union(spark, sf):
    union = B.price_history(spark, sf)
    return union.groupBy("source").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("asin").alias("keys")
    )


@query(
    "latest_per_day",
    chain(f"SELECT asin, {_DATE}, epoch_us(scraped_at) AS scraped_us, {r6('price')} AS price FROM sp"),
)
def latest_per_day(spark, sf):
    rows = clean_products(B.bronze_products(spark, sf))
    return rows.select(
        "asin", "scrape_date", F.unix_micros(F.col("scraped_at").cast("timestamp")).alias("scraped_us"), "price"
    )


@query(
    "stock_level",
    chain(f"SELECT stock AS raw, {STOCK_LEVEL} AS level, count(*) AS rows FROM bp GROUP BY 1, 2"),
)
def stock_level_query(spark, sf):
    rows = B.bronze_products(spark, sf).select(
        F.col("stock").alias("raw"), stock_level(F.col("stock")).alias("level")
    )
    return rows.groupBy("raw", "level").agg(F.count(F.lit(1)).alias("rows"))


_SIGNAL = """CASE WHEN stock IS NULL OR trim(stock) = '' OR contains(lower(stock), 'out of stock') OR contains(lower(stock), 'unavailable')
     OR lower(trim(stock)) = 'none' THEN {gone}
  WHEN contains(lower(stock), 'limited') OR contains(lower(stock), 'only') OR contains(lower(stock), 'few') THEN {low}
  WHEN contains(lower(stock), 'in stock') OR contains(lower(stock), 'available') THEN {ok}
  ELSE {other} END"""
_LEVEL = _SIGNAL.format(gone="'out_of_stock'", low="'low_stock'", ok="'in_stock'", other="'unknown'")
_SEVERITY = _SIGNAL.format(gone="'critical'", low="'warning'", ok="'ok'", other="'info'")
_ACTION = _SIGNAL.format(
    gone="'Restock immediately — product is unavailable.'",
    low="'Consider restocking soon.'",
    ok="NULL",
    other="'Verify stock status manually.'",
)


@query(
    "stock_signal",
    chain(
        f"SELECT stock AS raw, {_LEVEL} AS level, {_SEVERITY} AS severity, {_ACTION} AS action, count(*) AS rows "
        "FROM bp GROUP BY stock"
    ),
)
def stock_signal_query(spark, sf):
    rows = B.bronze_products(spark, sf).select(
        F.col("stock").alias("raw"), stock_signal(F.col("stock")).alias("s")
    )
    return rows.groupBy("raw", "s.level", "s.severity", "s.action").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "clean_title",
    chain("SELECT title, trim(split_part(split_part(title, '-', 1), '|', 1)) AS cleaned, count(*) AS rows FROM obs GROUP BY 1, 2"),
)
def clean_title_query(spark, sf):
    titles = B.bronze_products(spark, sf).select("title").unionByName(
        B.bronze_competitors(spark, sf).select("title")
    )
    return titles.groupBy("title", clean_title(F.col("title")).alias("cleaned")).agg(
        F.count(F.lit(1)).alias("rows")
    )


@query(
    "normalised_keys",
    "SELECT upper(trim('  b' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') || ' ')) AS asin, "
    "regexp_matches(upper(trim('  b' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') || ' ')), '^[A-Z0-9]{10}$') AS valid FROM part",
)
def normalised_keys(spark, sf):
    raw = F.concat(F.lit("  b"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"), F.lit(" "))
    rows = B.table(spark, sf, "part").select(normalise_key(raw).alias("asin"))
    return rows.withColumn("valid", valid_key(F.col("asin")))


@query(
    "competitor_map",
    chain(
        f"SELECT parent_asin, asin, {r6('price')} AS price, currency, {r6('rating')} AS rating, "
        f"{r6('price_diff_pct')} AS price_diff_pct, price_rank, {_DATE} FROM cmap"
    ),
)
def competitor_map_query(spark, sf):
    return B.rivals(spark, sf).drop("title", "brand")


@query(
    "competitor_map_described",
    chain(
        f"SELECT c.parent_asin, c.asin, d.title, d.brand, c.price_rank, CAST(c.scrape_date AS VARCHAR) AS scrape_date "
        "FROM cmap c JOIN (SELECT * FROM bc WHERE price > 0 QUALIFY row_number() OVER "
        "(PARTITION BY asin, parent_asin, scrape_date ORDER BY fetched_at DESC, price) = 1) d "
        "ON d.parent_asin = c.parent_asin AND d.asin = c.asin AND d.scrape_date = c.scrape_date"
    ),
)
def competitor_map_described(spark, sf):
    details = clean_competitors(B.bronze_competitors(spark, sf), carry=("title", "brand"))
    rows = competitor_map(B.stored_history(spark, sf), descriptions=details)
    return rows.select("parent_asin", "asin", "title", "brand", "price_rank", "scrape_date")


@query(
    "rolling_features",
    chain(f"SELECT asin, {_DATE}, {r6('price')} AS price, {r6('ma')} AS price_7d_ma, {r6('vol')} AS price_7d_volatility, {r6('mom')} AS price_momentum FROM roll"),
)
def rolling_features_query(spark, sf):
    return G.rolling_features(B.own_history(spark, sf)).drop("rating", "currency", "stock")


@query(
    "recent_rows",
    chain(f"SELECT asin, {_DATE}, {r6('price')} AS price FROM sp QUALIFY row_number() OVER (PARTITION BY asin ORDER BY scrape_date DESC) <= 5"),
)
def recent_rows(spark, sf):
    return last_rows_per(B.own_history(spark, sf), ["asin"], "scrape_date", 5).select(
        "asin", "scrape_date", "price"
    )


_LAND = (
    f"asin, {_DATE}, {r6('med')} AS comp_median_price, {r6('avg_price')} AS comp_avg_price, {r6('min_price')} AS comp_min_price, "
    f"{r6('max_price')} AS comp_max_price, n AS comp_count, {r6('avg_rating')} AS comp_avg_rating, below AS competitors_below"
)


@query("competitor_landscape", chain(f"SELECT {_LAND} FROM land"))
def competitor_landscape_query(spark, sf):
    return G.competitor_landscape(B.rivals(spark, sf))


@query("competitor_landscape_exact", chain(f"SELECT {_LAND} FROM land_exact"))
def competitor_landscape_exact(spark, sf):
    return G.competitor_landscape(B.stored_rivals(spark, sf), exact=True)


@query("competitors_below", chain(f"SELECT asin, {_DATE}, n AS comp_count, below AS competitors_below FROM land"))
def competitors_below(spark, sf):
    history = B.stored_history(spark, sf)
    own = G.own_prices(history).select("asin", "scrape_date", "price")
    rows = G.competitor_landscape(competitor_map(history), own=own)
    return rows.select("asin", "scrape_date", "comp_count", "competitors_below")


@query("gold_price_features", chain(f"SELECT {GOLD_COLUMNS} FROM gold"))
def gold_price_features(spark, sf):
    return B.gold(spark, sf)


@query("gold_price_features_exact", chain(f"SELECT {GOLD_COLUMNS} FROM gold_exact"))
def gold_price_features_exact(spark, sf):
    return B.gold(spark, sf, exact=True)


@query(
    "gold_price_features_day",
    chain(f"SELECT {GOLD_COLUMNS} FROM gold WHERE scrape_date = DATE '{B.DAY}'"),
)
def gold_price_features_day(spark, sf):
    history = B.stored_history(spark, sf)
    return G.gold_from_silver(history, competitor_map(history, B.DAY), as_of=B.DAY)


@query(
    "feature_view",
    chain(
        f"SELECT asin, {_DATE}, {r6('current_price')} AS current_price, {decimals('price_7d_ma', 2)} AS price_7d_ma, "
        f"{decimals('price_7d_volatility', 4)} AS price_7d_vol, {decimals('price_momentum * 100', 2)} AS momentum_pct, comp_count, "
        f"{decimals('comp_median_price', 2)} AS comp_median, {decimals('comp_pressure_score', 3)} AS pressure, "
        "suggested_price, price_position FROM gold"
    ),
)
def feature_view(spark, sf):
    return G.feature_view(B.gold(spark, sf))


@query(
    "price_vs_ma",
    chain(f"SELECT asin, {_DATE}, {r6('current_price')} AS current_price, {r6('price_7d_ma')} AS price_7d_ma, {r6('current_price - price_7d_ma')} AS diff FROM gold"),
)
def price_vs_ma(spark, sf):
    return G.price_vs_average(B.gold(spark, sf))


@query(
    "point_in_time",
    chain(
        "SELECT l.event_id, l.asin, CAST(g.scrape_date AS VARCHAR) AS feature_date, "
        f"{r6('g.current_price')} AS current_price, {r6('g.suggested_price')} AS suggested_price "
        "FROM (SELECT event_id, parent_asin AS asin, scrape_date FROM obs) l ASOF LEFT JOIN gold g "
        "ON l.asin = g.asin AND l.scrape_date >= g.scrape_date"
    ),
)
def point_in_time_query(spark, sf):
    labels = B.table(spark, sf, "events").selectExpr(
        "event_id", f"{B.SNAPSHOT['parent_asin']} AS asin", "ts"
    )
    found = point_in_time(labels, B.gold(spark, sf), ["current_price", "suggested_price"], "ts")
    return found.drop("ts")


# --- serving ------------------------------------------------------------------------


@query(
    "current_products",
    chain(
        f"SELECT asin, title, brand, {r6('price')} AS price, currency, stock, {r6('rating')} AS rating, epoch_us(scraped_at) AS scraped_us FROM bp "
        "QUALIFY row_number() OVER (PARTITION BY asin ORDER BY scraped_at DESC) = 1"
    ),
)
def current_products(spark, sf):
    rows = V.current_products(B.bronze_products(spark, sf))
    micros = F.unix_micros(F.col("scraped_at").cast("timestamp"))
    return rows.withColumn("scraped_us", micros).drop("scraped_at")


_LAST = "(SELECT parent_asin, max(scrape_date) AS d FROM obs GROUP BY parent_asin)"
_CURRENT = {"cc": f"SELECT b.* FROM bc b JOIN {_LAST} l ON l.parent_asin = b.parent_asin AND l.d = b.scrape_date"}


def _current_competitors(spark, sf):
    return V.current_competitors(*B.fetches(spark, sf))


@query(
    "current_competitors",
    chain(f"SELECT parent_asin, asin, title, brand, {r6('price')} AS price, currency, {r6('rating')} AS rating, CAST(scrape_date AS VARCHAR) AS fetched_at FROM cc", **_CURRENT),
)
def current_competitors(spark, sf):
    return _current_competitors(spark, sf)


@query(
    "competitors_of",
    chain(f"SELECT parent_asin, asin, {r6('price')} AS price FROM cc WHERE parent_asin = 'B000000010'", **_CURRENT),
)
def competitors_of(spark, sf):
    return V.competitors_of(_current_competitors(spark, sf), " b000000010 ").select(
        "parent_asin", "asin", "price"
    )


@query(
    "fetch_worklist",
    chain(
        "SELECT m.asin FROM (SELECT 'B' || lpad(CAST(p_partkey * 10 AS VARCHAR), 9, '0') AS asin FROM part) m "
        "WHERE NOT EXISTS (SELECT 1 FROM bc WHERE bc.parent_asin = m.asin)"
    ),
)
def fetch_worklist(spark, sf):
    manifest = B.table(spark, sf, "part").selectExpr(
        "'B' || lpad(CAST(p_partkey * 10 AS STRING), 9, '0') AS asin"
    )
    return V.fetch_worklist(manifest, B.bronze_competitors(spark, sf))


_MARKET = {
    **_CURRENT,
    "market": "SELECT parent_asin, median(price) AS med, avg(price) AS mean, min(price) AS low, max(price) AS high, "
    "CAST(count(price) AS INTEGER) AS n, avg(rating) AS rating FROM cc GROUP BY parent_asin HAVING count(price) > 0",
}
_STATS = f"{money('med')} AS median, {money('mean')} AS avg, {money('low')} AS min, {money('high')} AS max, n AS count"


@query("serving_price_stats", chain(f"SELECT parent_asin, {_STATS} FROM market", **_MARKET))
def serving_price_stats(spark, sf):
    return V.serving_price_stats(_current_competitors(spark, sf))


_ANALYSIS = {
    **_MARKET,
    "cp": "SELECT * FROM bp QUALIFY row_number() OVER (PARTITION BY asin ORDER BY scraped_at DESC) = 1",
    "joined": f"""SELECT p.*, m.n, {money('m.med')} AS median, {money('m.mean')} AS avg,
      {money(money('m.med') + " * CASE WHEN round(p.rating - m.rating, 6) > CAST(0.3 AS DOUBLE) THEN CAST(1.03 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END")} AS suggested
      FROM cp p LEFT JOIN market m ON m.parent_asin = p.asin""",
}


@query(
    "serving_analysis",
    chain(
        f"""SELECT asin, title, {r6('price')} AS current_price, coalesce(currency, 'USD') AS currency, n AS competitors, median, avg,
      CASE WHEN price IS NOT NULL THEN suggested END AS suggested_price,
      CASE WHEN price IS NOT NULL AND n IS NOT NULL THEN greatest(CAST(0 AS DOUBLE),
        coalesce(CAST(round(CAST(round((price - suggested) / nullif(price, 0) * 100, 6) AS DECIMAL(18, 6)), 1) AS DOUBLE), 0)) END AS discount_pct,
      CASE WHEN price IS NULL THEN NULL WHEN round(price - median * CAST(1.05 AS DOUBLE), 6) > 0 THEN 'above_market'
           WHEN round(price - median * CAST(0.95 AS DOUBLE), 6) < 0 THEN 'below_market'
           WHEN median IS NOT NULL THEN 'at_market' END AS price_position,
      {_LEVEL} AS stock_level, {_SEVERITY} AS severity FROM joined""",
        **_ANALYSIS,
    ),
)
def serving_analysis(spark, sf):
    rows = V.serving_analysis(V.current_products(B.bronze_products(spark, sf)), _current_competitors(spark, sf))
    return rows.select(
        "asin",
        "title",
        "current_price",
        "currency",
        F.col("price_stats.count").alias("competitors"),
        "price_stats.median",
        "price_stats.avg",
        "suggestion.suggested_price",
        "suggestion.discount_pct",
        "suggestion.price_position",
        F.col("stock_signal.level").alias("stock_level"),
        "stock_signal.severity",
    )


# --- upsert and checks ---------------------------------------------------------------

_KEYS = ["asin", "scrape_date", "source", "parent_asin"]
_HALF = "DATE '2024-01-20'"


@query(
    "upsert_merge",
    chain(
        f"SELECT asin, CASE WHEN scrape_date >= DATE '2024-01-10' THEN {r6('price * 2')} ELSE {r6('price')} END AS price, "
        f"currency, stock, {r6('rating')} AS rating, source, parent_asin, {_DATE} FROM silver"
    ),
)
def upsert_merge(spark, sf):
    """The table holds days up to the 20th; the load brings days from the 10th, repriced."""
    rows = _silver_columns(B.stored_history(spark, sf))
    target = rows.where(f"scrape_date <= {_HALF}")
    source = rows.where("scrape_date >= DATE '2024-01-10'").withColumn("price", F.col("price") * 2)
    return merge_rows(target, source, _KEYS)


@query(
    "upsert_idempotent",
    chain("SELECT source, count(*) AS once, count(*) AS twice FROM silver GROUP BY source"),
)
def upsert_idempotent(spark, sf):
    rows = _silver_columns(B.stored_history(spark, sf))
    once = merge_rows(rows.where(f"scrape_date <= {_HALF}"), rows, _KEYS)
    twice = merge_rows(once, rows, _KEYS)

    def count(df, name):
        return df.groupBy("source").agg(F.count(F.lit(1)).alias(name))

    return count(once, "once").join(count(twice, "twice"), "source")


@query(
    "duplicate_keys",
    chain("SELECT asin, CAST(scrape_date AS VARCHAR) AS scrape_date, count(*) AS rows FROM bp GROUP BY asin, scrape_date HAVING count(*) > 1"),
)
def duplicate_keys_query(spark, sf):
    rows = B.bronze_products(spark, sf).select("asin", F.to_date("scraped_at").alias("scrape_date"))
    return duplicate_keys(rows, ["asin", "scrape_date"])


_CHECKS = [
    ("bronze.products", "null ASIN", "bp WHERE asin IS NULL"),
    ("bronze.products", "zero or negative price", "bp WHERE price <= 0"),
    ("bronze.products", "future scraped_at", "bp WHERE scraped_at > TIMESTAMP '2024-01-29 00:00:00' + INTERVAL 1 HOUR"),
    ("bronze.products", "invalid ASIN format", "bp WHERE NOT regexp_matches(asin, '^[A-Z0-9]{10}$')"),
    ("bronze.products", "null currency", "bp WHERE currency IS NULL"),
    ("bronze.competitors", "null ASIN", "bc WHERE asin IS NULL OR parent_asin IS NULL"),
    ("bronze.competitors", "zero or negative price", "bc WHERE price <= 0"),
    ("silver.price_history", "null price", "silver WHERE price IS NULL"),
    ("silver.price_history", "price out of range", "silver WHERE price < 0.01 OR price > 100000"),
    ("silver.price_history", "invalid source", "silver WHERE source NOT IN ('product', 'competitor')"),
    ("silver.price_history", "duplicate (asin, scrape_date, source, parent_asin)",
     "(SELECT 1 FROM silver GROUP BY asin, scrape_date, source, parent_asin HAVING count(*) > 1)"),
    ("gold.price_features", "comp_pressure_score out of range", "gold WHERE comp_pressure_score < 0 OR comp_pressure_score > 1"),
    ("gold.price_features", "invalid price_position", "gold WHERE price_position NOT IN ('above_market', 'at_market', 'below_market')"),
    ("gold.price_features", "duplicate (asin, scrape_date)",
     "(SELECT 1 FROM gold GROUP BY asin, scrape_date HAVING count(*) > 1)"),
]
_REPORT = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS check_name, count(*) AS failing_rows, count(*) = 0 AS passed FROM {src}"
    for t, c, src in _CHECKS
)


def _report(spark, sf, **options):
    now = F.lit("2024-01-29 00:00:00").cast("timestamp_ntz")
    history = B.stored_history(spark, sf)
    tables = {
        "bronze.products": B.bronze_products(spark, sf),
        "bronze.competitors": B.bronze_competitors(spark, sf),
        "silver.price_history": history,
        "gold.price_features": stored(G.gold_from_silver(history, competitor_map(history)), "gold"),
    }
    return quality_report(tables, now, **options)


@query("quality_report", chain(_REPORT))
def quality_report_query(spark, sf):
    return _report(spark, sf)


@query("quality_failures", chain(f"SELECT * FROM ({_REPORT}) WHERE NOT passed"))
def quality_failures(spark, sf):
    return _report(spark, sf, only_failures=True)
