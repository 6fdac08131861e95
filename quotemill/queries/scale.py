"""The layer chain on the largest given table: line items as price observations.

A part is a product: its first lines are own prices, the other lines are the prices of
its suppliers, one observation per year.
"""

from __future__ import annotations

from ..operators.gold import competitor_landscape, gold_from_silver
from ..operators.silver import competitor_map, silver_price_history
from ..session import stored
from . import binding as B
from .oracle import CTES, GOLD_COLUMNS, landscape, r6
from .registry import query

_PRICE = "l_extendedprice"
_RATING = "CAST(3 AS DOUBLE) + CAST(CAST(l_quantity AS BIGINT) % 21 AS DOUBLE) / CAST(10 AS DOUBLE)"
_PART = "'P' || lpad(CAST(l_partkey AS STRING), 9, '0')"
_SUPPLIER = "'S' || lpad(CAST(l_suppkey AS STRING), 9, '0')"


def _history(spark, sf):
    lines = B.table(spark, sf, "lineitem")
    year = "date_trunc('YEAR', l_shipdate)"
    common = [f"{_PRICE} AS price", "'USD' AS currency", f"{_RATING} AS rating"]
    products = lines.where("l_linenumber = 1").selectExpr(
        f"{_PART} AS asin", *common, "'In Stock' AS stock", "l_shipdate AS scraped_at", f"{year} AS day"
    )
    rivals = lines.where("l_linenumber <> 1").selectExpr(
        f"{_PART} AS parent_asin", f"{_SUPPLIER} AS asin", *common, "l_shipdate AS fetched_at", f"{year} AS day"
    )
    # One observation per year: the year start plays the part of the day.
    yearly = silver_price_history(
        products.drop("scraped_at").withColumnRenamed("day", "scraped_at"),
        rivals.drop("fetched_at").withColumnRenamed("day", "fetched_at"),
    )
    return stored(yearly, "line_history")


_CHAIN = {
    "sp": f"""SELECT asin, price, currency, rating, scrape_date, 'in_stock' AS stock FROM (SELECT {_PART.replace('STRING', 'VARCHAR')} AS asin, {_PRICE} AS price, 'USD' AS currency,
      {_RATING} AS rating, CAST(date_trunc('year', l_shipdate) AS DATE) AS scrape_date FROM lineitem WHERE l_linenumber = 1)
      WHERE price > 0 QUALIFY row_number() OVER (PARTITION BY asin, scrape_date ORDER BY price, rating) = 1""",
    "sc": f"""SELECT parent_asin, asin, price, currency, rating, scrape_date FROM (SELECT {_PART.replace('STRING', 'VARCHAR')} AS parent_asin, {_SUPPLIER.replace('STRING', 'VARCHAR')} AS asin,
      {_PRICE} AS price, 'USD' AS currency, {_RATING} AS rating, CAST(date_trunc('year', l_shipdate) AS DATE) AS scrape_date FROM lineitem WHERE l_linenumber <> 1)
      WHERE price > 0 QUALIFY row_number() OVER (PARTITION BY asin, parent_asin, scrape_date ORDER BY price, rating) = 1""",
    "cmap": CTES["cmap"],
    "roll": CTES["roll"],
    "land": landscape("quantile_disc(price, 0.5)"),
    "gold": CTES["gold"],
    "land_exact": landscape("median(price)"),
    "gold_exact": CTES["gold_exact"],
}


def _chain(select: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({t})" for n, t in _CHAIN.items()) + "\n" + select


_DATE = "CAST(scrape_date AS VARCHAR) AS scrape_date"


@query(
    "lineitem_competitor_map",
    _chain(f"SELECT parent_asin, asin, {r6('price')} AS price, {r6('price_diff_pct')} AS price_diff_pct, price_rank, {_DATE} FROM cmap"),
)
def lineitem_competitor_map(spark, sf):
    rows = competitor_map(_history(spark, sf))
    return rows.select("parent_asin", "asin", "price", "price_diff_pct", "price_rank", "scrape_date")


@query(
    "lineitem_landscape_exact",
    _chain(f"SELECT asin, {_DATE}, {r6('med')} AS comp_median_price, {r6('avg_price')} AS comp_avg_price, n AS comp_count, below AS competitors_below FROM land_exact"),
)
def lineitem_landscape_exact(spark, sf):
    market = stored(competitor_map(_history(spark, sf)), "line_map")
    rows = competitor_landscape(market, exact=True)
    return rows.select(
        "asin", "scrape_date", "comp_median_price", "comp_avg_price", "comp_count", "competitors_below"
    )


@query("lineitem_gold", _chain(f"SELECT {GOLD_COLUMNS} FROM gold"))
def lineitem_gold(spark, sf):
    history = _history(spark, sf)
    return gold_from_silver(history, competitor_map(history))
