"""Sources and sinks fed with files and payloads that Spark derives from the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.merge import duplicate_keys
from ..plans import daily
from ..schemas import (
    BRONZE_PRODUCTS,
    GOLD_PRICE_FEATURES,
    OPS_LOAD_AUDIT,
    PRODUCT_SNAPSHOT,
    SILVER_PRICE_HISTORY,
)
from ..session import scratch_path
from ..sinks.bucketed import create_bucketed, upsert_bucketed
from ..sinks.files import write_csv, write_snapshots
from ..sinks.tables import append_table, read_table, rejected_rows, replace_partition, upsert_table
from ..sources import payloads as L
from ..sources import snapshots as S
from ..streaming.snapshots import stream_bronze_products
from . import binding as B
from .oracle import GOLD_COLUMNS, chain, r6
from .registry import query

_DATE = "CAST(scrape_date AS VARCHAR) AS scrape_date"


@query(
    "manifest_keys",
    "SELECT 'B' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS asin FROM part WHERE p_partkey % 10 <> 3",
)
def manifest_keys(spark, sf):
    """A manifest with padded lower-case keys, blank lines and comments."""
    path = scratch_path(spark, "manifest")
    key = "'b' || lpad(CAST(p_partkey AS STRING), 9, '0')"
    line = f"CASE WHEN p_partkey % 10 = 3 THEN '#' || {key} WHEN p_partkey % 4 = 1 THEN ' ' || {key} || '  ' ELSE {key} END"
    lines = B.table(spark, sf, "part").selectExpr(
        f"explode(array({line}, CASE WHEN p_partkey % 7 = 0 THEN '  ' ELSE '# note' END)) AS value"
    )
    lines.write.text(path)
    return S.read_manifest(spark, path)


def _product_events(spark, sf):
    """Every event as the scrape of one product."""
    snap = B.SNAPSHOT
    return B.table(spark, sf, "events").selectExpr(
        "event_id", "ts", "value", "event_type", f"{snap['asin']} AS asin", f"{snap['rating']} AS rating"
    )


def _product_payloads(spark, sf):
    """Product responses in the three shapes the provider uses, some without content."""
    fields = """named_struct(
        'asin', CASE WHEN event_id % 5 = 0 THEN NULL ELSE asin END,
        'title', 'Item ' || event_type,
        'price', value,
        'rating', rating,
        'stock', event_type,
        'category', CASE WHEN event_id % 2 = 0 THEN array('new', event_type) END,
        'categories', array('old'),
        'category_path', CASE WHEN event_id % 4 <> 0 THEN array(' Home ', '', event_type) END,
        'buybox', CASE WHEN event_id % 2 = 0 THEN array(named_struct('seller', event_type)) END)"""
    inner = f"to_json({fields})"
    shaped = f"""CASE event_id % 3
        WHEN 0 THEN CASE WHEN event_id % 41 = 0 THEN '{{"results":[{{"content":null}}]}}'
                         ELSE '{{"results":[{{"content":' || {inner} || '}}]}}' END
        WHEN 1 THEN '{{"content":' || {inner} || '}}'
        ELSE {inner} END"""
    return _product_events(spark, sf).selectExpr(
        "event_id",
        "asin AS queried_asin",
        f"CASE WHEN event_id % 13 = 0 THEN substring({shaped}, 1, 12) ELSE {shaped} END AS payload",
        "'com' AS amazon_domain",
        "'10001' AS geo_location",
        "ts AS scraped_at",
    )


_EMPTY = "(event_id % 3 = 0 AND event_id % 41 = 0)"
_OWN = "FROM obs JOIN (SELECT event_id AS id, value, event_type FROM events) e ON e.id = obs.event_id WHERE event_id % 13 <> 0"


@query(
    "payload_product",
    chain(
        f"""SELECT epoch_us(seen_at) AS scraped_us, asin,
        CASE WHEN {_EMPTY} THEN NULL ELSE 'Item ' || event_type END AS title,
        {r6(f'CASE WHEN {_EMPTY} THEN NULL ELSE value END')} AS price, {r6(f'CASE WHEN {_EMPTY} THEN NULL ELSE rating END')} AS rating,
        CASE WHEN {_EMPTY} THEN NULL ELSE event_type END AS stock,
        CASE WHEN {_EMPTY} THEN '' WHEN event_id % 2 = 0 THEN 'new,' || event_type ELSE 'old' END AS categories,
        CASE WHEN {_EMPTY} OR event_id % 4 = 0 THEN '' ELSE 'Home,' || event_type END AS category_path,
        CASE WHEN {_EMPTY} OR event_id % 2 = 1 THEN '[]' ELSE '[{{"seller":"' || event_type || '"}}]' END AS buybox,
        'com' AS amazon_domain, '10001' AS geo_location {_OWN}"""
    ),
)
def payload_product(spark, sf):
    good, _ = L.split_payloads(_product_payloads(spark, sf))
    rows = L.flatten_product_payload(good)
    return rows.select(
        F.unix_micros(F.col("scraped_at").cast("timestamp")).alias("scraped_us"),
        "asin",
        "title",
        "price",
        "rating",
        "stock",
        F.array_join("categories", ",").alias("categories"),
        F.array_join("category_path", ",").alias("category_path"),
        "buybox",
        "amazon_domain",
        "geo_location",
    )


@query(
    "payload_outcome",
    chain("SELECT count(*) FILTER (WHERE event_id % 13 <> 0) AS ok, count(*) FILTER (WHERE event_id % 13 = 0) AS failed FROM obs"),
)
def payload_outcome(spark, sf):
    return L.payload_outcome(_product_payloads(spark, sf))


def _search_payloads(spark, sf):
    """Search responses: six results, two of them repeats, sometimes the product itself."""
    item = """named_struct(
        'asin', CASE WHEN k % 2 = 0 AND NOT (k = 2 AND event_id % 11 = 0)
                     THEN 'B' || lpad(CAST(user_id + (k * 3 + event_id) % 4 AS STRING), 9, '0') END,
        'product_asin', CASE WHEN k % 2 = 1 THEN 'B' || lpad(CAST(user_id + (k * 3 + event_id) % 4 AS STRING), 9, '0') END,
        'title', 'Result ' || CAST(k AS STRING), 'price', value + k, 'currency', 'USD')"""

    def items(low: int, high: int) -> str:
        return f"to_json(transform(sequence({low}, {high}), k -> {item}))"

    payload = f"""CASE event_id % 3
        WHEN 0 THEN '{{"results":[{{"content":{{"results":{{"organic":' || {items(0, 3)} || ',"paid":' || {items(4, 5)} || '}}}}}}]}}'
        WHEN 1 THEN '{{"content":{{"results":{{"organic":null,"paid":' || {items(0, 5)} || '}}}}}}'
        ELSE '{{"products":' || {items(0, 5)} || '}}' END"""
    return B.table(spark, sf, "events").selectExpr(
        f"{B.SNAPSHOT['asin']} AS parent_asin",
        f"{payload} AS payload",
        "'com' AS amazon_domain",
        "ts AS fetched_at",
    )


@query(
    "payload_competitors",
    f"""SELECT parent_asin, fetched_us, asin, 'Result ' || k AS title, {r6('price')} AS price,
      'https://www.amazon.com/dp/' || asin AS url FROM (
        SELECT 'B' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS parent_asin, epoch_us(ts) AS fetched_us, event_id, k, value + k AS price,
          CASE WHEN k = 2 AND event_id % 11 = 0 THEN NULL
               ELSE 'B' || lpad(CAST(user_id + (k * 3 + event_id) % 4 AS VARCHAR), 9, '0') END AS asin
        FROM events CROSS JOIN range(6) AS r(k))
      WHERE asin IS NOT NULL AND asin <> parent_asin
      QUALIFY row_number() OVER (PARTITION BY event_id, asin ORDER BY k) = 1""",
)
def payload_competitors(spark, sf):
    rows = L.flatten_search_payload(_search_payloads(spark, sf))
    micros = F.unix_micros(F.col("fetched_at").cast("timestamp"))
    return rows.select("parent_asin", micros.alias("fetched_us"), "asin", "title", "price", "url")


@query(
    "snapshot_products",
    chain(
        f"SELECT {_DATE}, count(*) AS rows, count(price) AS priced, {r6('sum(price)')} AS total_price FROM "
        "(SELECT scrape_date, CASE WHEN event_id % 17 = 0 THEN NULL ELSE price END AS price FROM obs "
        "WHERE event_id % 19 <> 0) GROUP BY scrape_date"
    ),
)
def snapshot_products(spark, sf):
    """Products as JSON lines in one run-day folder, with unreadable prices and missing keys."""
    root = scratch_path(spark, "snapshots")
    snap = B.SNAPSHOT
    price = f"CASE WHEN event_id % 17 = 0 THEN '\"n/a\"' ELSE coalesce(CAST({snap['price']} AS STRING), 'null') END"
    rest = (
        f"to_json(named_struct('asin', CASE WHEN event_id % 19 = 0 THEN NULL ELSE {snap['asin']} END, "
        f"'stock', {snap['stock']}, 'scraped_at', date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")))"
    )
    lines = B.table(spark, sf, "events").selectExpr(
        f"'{{\"price\":' || {price} || ',' || substring({rest}, 2) AS value"
    )
    lines.write.text(f"{root}/products/{B.DAY}")
    rows = S.read_products(spark, root, B.DAY, multi_line=False)
    return rows.groupBy(F.to_date("scraped_at").alias("scrape_date")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("price").alias("priced"),
        F.sum("price").alias("total_price"),
    )


@query(
    "snapshot_competitors",
    chain(
        f"SELECT parent_asin, {_DATE}, count(*) AS rows, {r6('sum(price)')} AS total_price FROM "
        "(SELECT parent_asin, scrape_date, price FROM bc UNION ALL SELECT parent_asin, scrape_date, price FROM bc) "
        "GROUP BY parent_asin, scrape_date"
    ),
)
def snapshot_competitors(spark, sf):
    """Competitor snapshots as arrays of two objects; every element is one row."""
    root = scratch_path(spark, "snapshots")
    rows = B.bronze_competitors(spark, sf).withColumn(
        "fetched_at", F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    )
    element = F.struct("parent_asin", "asin", "title", "price", "currency", "rating", "fetched_at")
    rows.select(F.to_json(F.array(element, element)).alias("value")).write.text(
        f"{root}/competitors/{B.DAY}"
    )
    read = S.read_competitors(spark, root, B.DAY, multi_line=False)
    return read.groupBy("parent_asin", F.to_date("fetched_at").alias("scrape_date")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("price").alias("total_price")
    )


@query(
    "snapshot_quarantine",
    chain("SELECT count(*) FILTER (WHERE event_id % 13 <> 0) AS ok, count(*) FILTER (WHERE event_id % 13 = 0) AS failed FROM obs"),
)
def snapshot_quarantine(spark, sf):
    path = scratch_path(spark, "broken")
    text = "to_json(named_struct('asin', asin, 'price', value))"
    _product_events(spark, sf).selectExpr(
        f"CASE WHEN event_id % 13 = 0 THEN substring({text}, 1, 9) ELSE {text} END AS value"
    ).write.text(path)
    rows = S.read_json_folder(spark, path, PRODUCT_SNAPSHOT, multi_line=False)
    good, bad = S.split_corrupt(rows)
    return good.agg(F.count(F.lit(1)).alias("ok")).crossJoin(bad.agg(F.count(F.lit(1)).alias("failed")))


def _write_snapshots(spark, sf, root):
    """All products and competitors as the JSON lines of one run day."""
    utc = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    products = B.bronze_products(spark, sf).withColumn("scraped_at", F.date_format("scraped_at", utc))
    rivals = B.bronze_competitors(spark, sf).withColumn("fetched_at", F.date_format("fetched_at", utc))
    write_snapshots(products, root, "products", B.DAY)
    write_snapshots(rivals, root, "competitors", B.DAY)


@query("warehouse_backfill", chain(f"SELECT {GOLD_COLUMNS} FROM gold"))
def warehouse_backfill(spark, sf):
    """Snapshot files → bronze → silver → gold through the stored tables of all layers."""
    snapshots, root = scratch_path(spark, "snapshots"), scratch_path(spark, "warehouse")
    _write_snapshots(spark, sf, snapshots)
    daily.load_bronze(spark, root, snapshots, B.DAY, multi_line=False)
    daily.build_silver(spark, root, None)
    daily.build_gold(spark, root, None)
    return read_table(spark, root, GOLD_PRICE_FEATURES).drop("_computed_at")


@query(
    "stream_bronze",
    chain(f"SELECT {_DATE}, count(*) AS rows, {r6('sum(price)')} AS total_price FROM bp GROUP BY scrape_date"),
)
def stream_bronze(spark, sf):
    """The snapshot folder drained as a stream into the bronze table."""
    snapshots, root = scratch_path(spark, "snapshots"), scratch_path(spark, "warehouse")
    _write_snapshots(spark, sf, snapshots)
    stream_bronze_products(
        spark, snapshots, root, scratch_path(spark, "stream-state"), multi_line=False
    ).awaitTermination()
    rows = read_table(spark, root, BRONZE_PRODUCTS)
    return rows.groupBy(F.col("ingest_date").alias("scrape_date")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("price").alias("total_price")
    )


@query(
    "missing_snapshot_day",
    chain(f"SELECT '{B.DAY}' AS day, count(*) AS rows FROM bp UNION ALL SELECT '1999-01-01', CAST(0 AS BIGINT)"),
)
def missing_snapshot_day(spark, sf):
    """A day without a folder reads as an empty table; reported as a coverage row."""
    root = scratch_path(spark, "snapshots")
    rows = B.bronze_products(spark, sf).select("asin", "price")
    rows.write.json(f"{root}/products/{B.DAY}")
    present = S.read_products(spark, root, B.DAY, multi_line=False)
    absent = S.read_products(spark, root, "1999-01-01", multi_line=False)
    counts = [
        df.agg(F.lit(day).alias("day"), F.count(F.lit(1)).alias("rows"))
        for day, df in ((B.DAY, present), ("1999-01-01", absent))
    ]
    return counts[0].unionByName(counts[1])


@query(
    "csv_price_history",
    chain(f"SELECT asin, {_DATE}, {r6('price')} AS price, currency, {r6('rating')} AS rating, stock FROM sp"),
)
def csv_price_history(spark, sf):
    path = scratch_path(spark, "csv")
    rows = B.own_history(spark, sf).select("asin", "scrape_date", "price", "currency", "rating", "stock")
    write_csv(rows, path)
    return S.read_csv(spark, path, rows.schema)


def _two_loads(spark, sf):
    """Days up to the 20th, then every day again with doubled prices."""
    root = scratch_path(spark, "warehouse")
    rows = B.stored_history(spark, sf)
    upsert_table(rows.where("scrape_date <= DATE '2024-01-20'"), SILVER_PRICE_HISTORY, root, "first")
    doubled = rows.withColumn("price", F.col("price") * 2)
    upsert_table(
        doubled, SILVER_PRICE_HISTORY, root, "second",
        ["price", "currency", "stock", "rating", "scraped_at"],
    )
    return root


@query(
    "upsert_table",
    chain(f"SELECT asin, {r6('price * 2')} AS price, currency, stock, {r6('rating')} AS rating, source, parent_asin, {_DATE} FROM silver"),
)
def upsert_table_query(spark, sf):
    rows = read_table(spark, _two_loads(spark, sf), SILVER_PRICE_HISTORY)
    return rows.drop("scraped_at", "_updated_at")


@query(
    "catalog_price_history",
    chain(f"SELECT asin, {r6('price')} AS price, currency, stock, {r6('rating')} AS rating, source, parent_asin, {_DATE} FROM silver"),
)
def catalog_price_history(spark, sf):
    """The table read by name after two loads."""
    root = scratch_path(spark, "catalog")
    name = SILVER_PRICE_HISTORY.full_name
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {SILVER_PRICE_HISTORY.layer}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(SILVER_PRICE_HISTORY.ddl(SILVER_PRICE_HISTORY.path(root)))
    rows = B.stored_history(spark, sf)
    upsert_table(rows.where("scrape_date <= DATE '2024-01-20'"), SILVER_PRICE_HISTORY, root, "first")
    upsert_table(rows, SILVER_PRICE_HISTORY, root, "second")
    return spark.table(name).drop("scraped_at", "_updated_at")


@query(
    "not_null_rejections",
    chain("SELECT DISTINCT CAST(scrape_date AS VARCHAR) AS scrape_date, TRUE AS rejected, CAST(0 AS BIGINT) AS stored FROM silver WHERE source = 'product'"),
)
def not_null_rejections(spark, sf):
    """Loads whose rows lack a price are refused before anything is written."""
    root = scratch_path(spark, "rejected")
    rows = B.stored_history(spark, sf).where("source = 'product'")
    try:
        upsert_table(rows.withColumn("price", F.lit(None).cast("double")), SILVER_PRICE_HISTORY, root, "bad")
        rejected = False
    except ValueError:
        rejected = True
    stored_rows = read_table(spark, root, SILVER_PRICE_HISTORY).count()
    return rows.select("scrape_date").distinct().select(
        "scrape_date", F.lit(rejected).alias("rejected"), F.lit(stored_rows).cast("long").alias("stored")
    )


@query(
    "upsert_bucketed",
    chain(
        f"SELECT asin, {r6('CASE WHEN scrape_date <= DATE ' + repr('2024-01-10') + ' AND round(price, 2) > 50 THEN price ELSE price + 1 END')} AS price, source, parent_asin, CAST(scrape_date AS VARCHAR) AS scrape_date FROM silver "
    ),
)
def upsert_bucketed_query(spark, sf):
    """Two loads into a bucketed table: days up to the 10th first, then all days, dearer by
    one; the dear rows of the second load carry an older time and must not win."""
    rows = B.stored_history(spark, sf)
    name = f"price_buckets_{uuid.uuid4().hex}"
    create_bucketed(spark, SILVER_PRICE_HISTORY, name, 8, scratch_path(spark, name))
    first = rows.where("scrape_date <= DATE '2024-01-10'")
    upsert_bucketed(first, SILVER_PRICE_HISTORY, name, newer="scraped_at")
    older = F.when(F.round("price", 2) > 50, F.expr("scraped_at - INTERVAL 1 HOUR")).otherwise(F.col("scraped_at"))
    changed = rows.withColumns({"price": F.col("price") + 1, "scraped_at": older})
    upsert_bucketed(changed, SILVER_PRICE_HISTORY, name, newer="scraped_at")
    return spark.table(name).select("asin", "price", "source", "parent_asin", "scrape_date")


@query(
    "rejected_rows",
    chain(
        "SELECT operation, lacks, count(*) AS rows, (SELECT count(*) FROM blanked WHERE asin IS NOT NULL AND price IS NOT NULL) AS stored "
        "FROM (SELECT *, CASE WHEN asin IS NULL AND price IS NULL THEN 'asin,price' WHEN asin IS NULL THEN 'asin' ELSE 'price' END AS lacks FROM blanked "
        "WHERE asin IS NULL OR price IS NULL), (SELECT unnest(['APPEND', 'MERGE', 'REPLACE']) AS operation) GROUP BY operation, lacks",
        blanked="SELECT CASE WHEN epoch_us(scraped_at) % 11 = 0 THEN NULL ELSE asin END AS asin, "
        "CASE WHEN epoch_us(scraped_at) % 7 = 0 THEN NULL ELSE price END AS price FROM silver",
    ),
)
def rejected_rows_query(spark, sf):
    """Rows that lack a NOT NULL value, by writer and columns, and the rows that were stored."""
    micros = F.unix_micros(F.col("scraped_at").cast("timestamp"))
    blanked = B.stored_history(spark, sf).withColumns(
        {"asin": F.when(micros % 11 != 0, F.col("asin")), "price": F.when(micros % 7 != 0, F.col("price"))}
    )
    parts = []
    for operation, write in (("APPEND", append_table), ("MERGE", upsert_table), ("REPLACE", replace_partition)):
        root = scratch_path(spark, "quarantine")
        write(blanked, SILVER_PRICE_HISTORY, root, "bad", quarantine=True)
        held = read_table(spark, root, SILVER_PRICE_HISTORY).agg(F.count(F.lit(1)).alias("stored"))
        refused = rejected_rows(spark, root, SILVER_PRICE_HISTORY).groupBy(F.array_join("_lacks", ",").alias("lacks"))
        parts.append(
            refused.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(operation).alias("operation"), "lacks", "rows").crossJoin(F.broadcast(held))
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_FIRST = "count(*) FILTER (WHERE scrape_date <= DATE '2024-01-20')"


@query(
    "load_audit",
    chain(
        f"SELECT 'silver.price_history' AS table_name, 'first' AS batch, 'MERGE' AS operation, {_FIRST} AS rows_in, {_FIRST} AS inserted, CAST(0 AS BIGINT) AS updated FROM silver "
        f"UNION ALL SELECT 'silver.price_history', 'second', 'MERGE', count(*), count(*) - {_FIRST}, {_FIRST} FROM silver"
    ),
)
def load_audit(spark, sf):
    return read_table(spark, _two_loads(spark, sf), OPS_LOAD_AUDIT).drop("loaded_at")


@query(
    "append_table",
    chain("SELECT source, count(*) * 2 AS rows, count(*) AS repeated FROM silver GROUP BY source"),
)
def append_table_query(spark, sf):
    """Appending the same rows twice keeps both copies."""
    root = scratch_path(spark, "warehouse")
    rows = B.stored_history(spark, sf)
    for batch in ("first", "second"):
        append_table(rows, SILVER_PRICE_HISTORY, root, batch)
    table = read_table(spark, root, SILVER_PRICE_HISTORY)
    repeated = duplicate_keys(table, SILVER_PRICE_HISTORY.keys)
    return repeated.groupBy("source").agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("repeated")
    )
