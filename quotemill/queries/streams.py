"""Streaming queries: the batch form has a SQL twin, the stream runs over the same table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..schemas import OPS_LOAD_AUDIT, SILVER_PRICE_HISTORY
from ..session import scratch_path
from ..sinks.tables import read_table
from ..streaming.joins import competitor_prices
from ..streaming.snapshots import upsert_silver_stream
from ..streaming.windows import first_per_snapshot, price_sessions, price_windows
from . import binding as B
from .oracle import chain, r6
from .registry import query

_STATS = f"count(*) AS rows, {r6('avg(price)')} AS avg_price, {r6('min(price)')} AS min_price, {r6('max(price)')} AS max_price"


def _micros(df):
    for name in ("start", "end"):
        df = df.withColumn(name, F.unix_micros(F.col(name).cast("timestamp")))
    return df


def _batch(spark, sf):
    """Every event as a price observation."""
    snap = B.SNAPSHOT
    return B.table(spark, sf, "events").selectExpr(
        f"{snap['asin']} AS asin", f"{snap['price']} AS price", "CAST(ts AS TIMESTAMP) AS scraped_at"
    )


@query(
    "window_tumbling",
    chain(
        f"SELECT asin, epoch_us(CAST(scrape_date AS TIMESTAMP)) AS start, epoch_us(CAST(scrape_date AS TIMESTAMP) + INTERVAL 1 DAY) AS \"end\", {_STATS} "
        "FROM obs GROUP BY asin, scrape_date"
    ),
)
def window_tumbling(spark, sf):
    return _micros(price_windows(_batch(spark, sf)))


@query(
    "window_sliding",
    chain(
        f"SELECT asin, epoch_us(s) AS start, epoch_us(s + INTERVAL 2 DAY) AS \"end\", {_STATS} FROM "
        "(SELECT *, unnest([CAST(scrape_date AS TIMESTAMP), CAST(scrape_date AS TIMESTAMP) - INTERVAL 1 DAY]) AS s FROM obs) GROUP BY asin, s"
    ),
)
def window_sliding(spark, sf):
    return _micros(price_windows(_batch(spark, sf), size="2 days", slide="1 day"))


@query(
    "window_session",
    chain(
        f"SELECT asin, epoch_us(min(seen_at)) AS start, epoch_us(max(seen_at) + INTERVAL 6 HOUR) AS \"end\", {_STATS} FROM "
        "(SELECT *, sum(fresh) OVER (PARTITION BY asin ORDER BY seen_at) AS session FROM (SELECT *, "
        "CASE WHEN seen_at <= lag(seen_at) OVER (PARTITION BY asin ORDER BY seen_at) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM obs)) "
        "GROUP BY asin, session"
    ),
)
def window_session(spark, sf):
    return _micros(price_sessions(_batch(spark, sf)))


def _stream(spark, sf, events=None):
    """The event table as a stream of product snapshots."""
    if events is None:
        schema = B.table(spark, sf, "events").schema
        events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    snap = B.SNAPSHOT
    products = events.where("user_id % 10 = 0").selectExpr(
        *[f"{snap[c]} AS {c}" for c in ("asin", "price", "currency", "stock", "rating")],
        "CAST(ts AS TIMESTAMP) AS scraped_at",
    )
    rivals = events.where("user_id % 10 <> 0").selectExpr(
        *[f"{snap[c]} AS {c}" for c in ("parent_asin", "asin", "price", "currency", "rating")],
        "CAST(ts AS TIMESTAMP) AS fetched_at",
    )
    return products, rivals


@query(
    "stream_deduplicated",
    chain("SELECT asin, count(*) AS rows FROM (SELECT DISTINCT asin, scraped_at FROM bp) GROUP BY asin"),
)
def stream_deduplicated(spark, sf):
    products, _ = _stream(spark, sf)
    out = scratch_path(spark, "stream-rows")
    unique = first_per_snapshot(products, ["asin", "scraped_at"], "scraped_at", "30 days")
    run = (
        unique.writeStream.format("parquet")
        .option("checkpointLocation", scratch_path(spark, "stream-state"))
        .option("path", out)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return spark.read.parquet(out).groupBy("asin").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "stream_upsert",
    chain(f"SELECT asin, {r6('price')} AS price, currency, stock, source, parent_asin, CAST(scrape_date AS VARCHAR) AS scrape_date FROM silver"),
)
def stream_upsert(spark, sf):
    root = scratch_path(spark, "warehouse")
    products, rivals = _stream(spark, sf)
    upsert_silver_stream(products, rivals, root, scratch_path(spark, "stream-state")).awaitTermination()
    rows = read_table(spark, root, SILVER_PRICE_HISTORY)
    return rows.drop("scraped_at", "_updated_at", "rating")


_HALF = "2024-01-16"


def _halves(spark, sf, late: bool = False):
    """The events as a stream of two batches, cut by day; ``late`` sends every seventh event
    of the first half with the second."""
    events = B.table(spark, sf, "events")
    first = F.to_date("ts") < F.lit(_HALF)
    if late:
        first = first & (F.col("event_id") % 7 != 0)
    folder = scratch_path(spark, "events")
    for half in (events.where(first), events.where(~first)):
        half.coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)


@query(
    "stream_replayed_batches",
    chain(
        f"SELECT CAST(scrape_date >= DATE '{_HALF}' AS INTEGER) AS number, CAST(1 AS BIGINT) AS begun, CAST(1 AS BIGINT) AS done, count(*) AS rows_in, "
        "count(*) AS inserted, CAST(0 AS BIGINT) AS updated, (SELECT count(*) FROM silver) AS stored "
        "FROM silver GROUP BY scrape_date >= DATE '" + _HALF + "'"
    ),
)
def stream_replayed_batches(spark, sf):
    """Every batch is delivered twice; the audit shows one load each, the table no change."""
    root = scratch_path(spark, "warehouse")
    products, rivals = _stream(spark, sf, _halves(spark, sf))
    upsert_silver_stream(products, rivals, root, scratch_path(spark, "stream-state"), deliveries=2).awaitTermination()
    held = read_table(spark, root, SILVER_PRICE_HISTORY).agg(F.count(F.lit(1)).alias("stored"))
    begun = F.col("operation") == "BEGIN"
    audit = read_table(spark, root, OPS_LOAD_AUDIT).groupBy(
        F.substring_index("batch", "/", -1).cast("int").alias("number")
    )
    sums = [F.sum(c).alias(c) for c in ("rows_in", "inserted", "updated")]
    return audit.agg(F.count_if(begun).alias("begun"), F.count_if(~begun).alias("done"), *sums).crossJoin(F.broadcast(held))


_JOINED = (
    f"SELECT c.parent_asin, c.asin, epoch_us(c.fetched_at) AS fetched_at, epoch_us(p.scraped_at) AS scraped_at, {r6('c.price')} AS price, "
    f"{r6('p.price')} AS own_price, {r6('(c.price - p.price) * 100 / nullif(p.price, 0)')} AS price_diff_pct FROM bc c JOIN bp p "
    "ON p.asin = c.parent_asin AND p.scraped_at <= c.fetched_at AND p.scraped_at > c.fetched_at - INTERVAL 1 DAY "
    "WHERE c.price IS NOT NULL AND p.price IS NOT NULL"
)


def _joined_micros(df):
    for name in ("fetched_at", "scraped_at"):
        df = df.withColumn(name, F.unix_micros(F.col(name).cast("timestamp")))
    return df


@query("competitor_prices", chain(_JOINED))
def competitor_prices_query(spark, sf):
    own = B.bronze_products(spark, sf)
    return _joined_micros(competitor_prices(own, B.bronze_competitors(spark, sf)))


@query("stream_competitor_prices", chain(_JOINED))
def stream_competitor_prices(spark, sf):
    """The join on two streams whose second batch brings late rows of the first half."""
    products, _ = _stream(spark, sf, _halves(spark, sf, late=True))
    _, rivals = _stream(spark, sf, _halves(spark, sf, late=True))
    out = scratch_path(spark, "stream-rows")
    joined = competitor_prices(products, rivals, lateness="30 days")
    run = (
        joined.writeStream.format("parquet")
        .option("checkpointLocation", scratch_path(spark, "stream-state"))
        .option("path", out)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return _joined_micros(spark.read.schema(joined.schema).parquet(out))
