"""Streams over small folders, compared with the batch form."""

import json

import pytest
from pyspark.sql import functions as F

from quotemill.operators.merge import merge_rows
from quotemill.operators.silver import silver_price_history
from quotemill.queries import binding as B
from quotemill.schemas import BRONZE_COMPETITORS, BRONZE_PRODUCTS, OPS_LOAD_AUDIT, SILVER_PRICE_HISTORY
from quotemill.session import scratch_path
from quotemill.sinks import tables
from quotemill.sinks.tables import MicroBatch, append_table, read_table
from quotemill.streaming.joins import competitor_prices
from quotemill.streaming.snapshots import (
    stream_bronze_competitors,
    stream_bronze_products,
    upsert_silver_stream,
)
from quotemill.streaming.windows import first_per_snapshot, price_windows


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def product(asin, at, price):
    return {"asin": asin, "price": price, "stock": "In Stock", "currency": "USD", "scraped_at": at}


@pytest.fixture()
def folders(tmp_path):
    def put(kind, day, name, content):
        path = tmp_path / "snapshots" / kind / day / f"{name}.json"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(content))

    return put, str(tmp_path / "snapshots"), str(tmp_path / "warehouse"), str(tmp_path / "state")


def test_bronze_then_silver_with_late_data(spark, folders):
    put, snapshots, root, state = folders
    put("products", "2024-05-01", "A", product("A", "2024-05-01T10:00:00Z", 10.0))
    put("competitors", "2024-05-01", "A", [{"parent_asin": "A", "asin": "X", "price": 9.0, "currency": "USD", "fetched_at": "2024-05-01T10:00:00Z"}])

    def drain():
        stream_bronze_products(spark, snapshots, root, f"{state}/p").awaitTermination()
        stream_bronze_competitors(spark, snapshots, root, f"{state}/c").awaitTermination()
        tables = [
            spark.readStream.schema(t.schema).parquet(t.path(root)) for t in (BRONZE_PRODUCTS, BRONZE_COMPETITORS)
        ]
        upsert_silver_stream(*tables, root, f"{state}/s").awaitTermination()
        return {(r.asin, r.price) for r in read_table(spark, root, SILVER_PRICE_HISTORY).collect()}

    assert drain() == {("A", 10.0), ("X", 9.0)}
    put("products", "2024-05-01", "A2", product("A", "2024-05-01T12:00:00Z", 12.0))
    assert drain() == {("A", 12.0), ("X", 9.0)}
    put("products", "2024-05-01", "A3", product("A", "2024-05-01T08:00:00Z", 8.0))  # late and older
    assert drain() == {("A", 12.0), ("X", 9.0)}
    assert read_table(spark, root, BRONZE_PRODUCTS).count() == 3


def test_merge_keeps_newer_rows(spark):
    schema = "asin string, parent_asin string, scraped_at int"
    old = spark.createDataFrame([("A", None, 5), ("B", "p", 5), ("D", "q", None)], schema).withColumn("v", F.lit("old"))
    new = spark.createDataFrame([("A", None, 4), ("B", "p", 6), ("C", None, 1), ("D", "q", 1)], schema).withColumn("v", F.lit("new"))
    got = merge_rows(old, new, ("asin", "parent_asin"), flags=True, newer="scraped_at")
    assert rows(got.select("asin", "v", "_matched", "_inserted")) == [
        ("A", "old", False, False), ("B", "new", True, False), ("C", "new", False, True), ("D", "new", True, False)
    ]


def loads(spark, root):
    audit = read_table(spark, root, OPS_LOAD_AUDIT)
    return sorted((r.batch, r.operation, r.rows_in, r.inserted) for r in audit.collect())


def test_append_after_a_cut_off_write(spark, tmp_path):
    """The rows are stored, the audit row is not: a replay adds what is missing only."""
    root = str(tmp_path)
    at = F.lit("2024-05-01 10:00:00").cast("timestamp")
    batch = spark.range(6).select(F.concat(F.lit("B"), "id").alias("asin"), at.alias("scraped_at"), F.to_date(at).alias("ingest_date"))
    name = MicroBatch("q", 3)
    with pytest.MonkeyPatch.context() as patch:
        whole = tables._audit

        def lost(*args, **kw):
            if args[4] != "BEGIN":
                raise OSError("driver lost")
            return whole(*args, **kw)

        patch.setattr(tables, "_audit", lost)
        with pytest.raises(OSError):
            append_table(batch.where("asin <> 'B5'"), BRONZE_PRODUCTS, root, name)
    assert loads(spark, root) == [("q/3", "BEGIN", 0, 0)]
    assert append_table(batch, BRONZE_PRODUCTS, root, name)["inserted"] == 1
    assert append_table(batch, BRONZE_PRODUCTS, root, name)["replayed"]
    assert read_table(spark, root, BRONZE_PRODUCTS).count() == 6
    assert loads(spark, root) == [("q/3", "APPEND", 6, 1), ("q/3", "BEGIN", 0, 0)]


def test_joined_state_is_bounded_by_the_watermark(spark, tmp_path):
    """Old rows leave the state, late ones within the lateness still meet."""
    stream = tmp_path / "in"
    own = spark.createDataFrame([], "asin string, price double, scraped_at timestamp, parent_asin string, fetched_at timestamp").schema

    def put(name, rows_):
        path = stream / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("\n".join(json.dumps(r) for r in rows_))

    def drain():
        source = spark.readStream.schema(own).json(str(stream))
        joined = competitor_prices(
            source.where("scraped_at IS NOT NULL").select("asin", "price", "scraped_at"),
            source.where("fetched_at IS NOT NULL").select("parent_asin", "asin", "price", "fetched_at"),
            within="2 hours", lateness="1 hour",
        )
        run = (
            joined.writeStream.format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        )
        run.awaitTermination()
        found = spark.read.schema(joined.schema).parquet(str(tmp_path / "out")).select("asin", "own_price").collect()
        return sorted(map(tuple, found)), run.lastProgress["stateOperators"][0]["numRowsTotal"]

    def product(at, price):
        return {"asin": "P", "price": price, "scraped_at": f"2024-05-0{at}Z"}

    def rival(at, asin):
        return {"parent_asin": "P", "asin": asin, "price": 9.0, "fetched_at": f"2024-05-0{at}Z"}

    put("1.json", [product("1T10:00:00", 10.0), rival("1T11:00:00", "X"), rival("1T09:00:00", "early")])
    assert drain() == ([("X", 10.0)], 3)
    put("2.json", [rival("1T10:30:00", "late"), product("2T10:00:00", 20.0), rival("2T10:30:00", "Y")])
    found, held = drain()
    assert found == [("X", 10.0), ("Y", 20.0), ("late", 10.0)]
    put("3.json", [product("3T10:00:00", 30.0), rival("3T10:00:00", "Z")])
    found, held = drain()
    assert found == [("X", 10.0), ("Y", 20.0), ("Z", 30.0), ("late", 10.0)]
    put("4.json", [rival("3T10:05:00", "Z2")])
    assert drain()[1] <= 4


def event_stream(spark, sf):
    schema = B.table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return events.where("user_id % 10 = 0").selectExpr(
        f"{B.SNAPSHOT['asin']} AS asin", f"{B.SNAPSHOT['price']} AS price", "CAST(ts AS TIMESTAMP) AS scraped_at"
    )


def test_windows_on_a_stream_equal_the_batch(spark, sf):
    batch = B.bronze_products(spark, sf).withColumn("scraped_at", F.col("scraped_at").cast("timestamp"))
    out, state = scratch_path(spark, "windows"), scratch_path(spark, "state")
    query = (
        price_windows(event_stream(spark, sf))
        .writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", state)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    streamed = spark.read.parquet(out)
    assert streamed.count() > 0
    # windows still open at the end of the input are not emitted yet
    closed = price_windows(batch).join(streamed.select("asin", "start"), ["asin", "start"], "left_semi")
    assert rows(streamed.select("asin", "start", "rows", "avg_price")) == rows(closed.select("asin", "start", "rows", "avg_price"))


def test_duplicates_on_a_batch(spark):
    df = spark.createDataFrame([("A", 1), ("A", 1), ("B", 1)], "asin string, at int")
    assert first_per_snapshot(df, ["asin", "at"], "at").count() == 2


def test_stream_upsert_equals_batch(spark, sf):
    from quotemill.queries.streams import _stream

    root = scratch_path(spark, "warehouse")
    upsert_silver_stream(*_stream(spark, sf), root, scratch_path(spark, "state")).awaitTermination()
    batch = silver_price_history(B.bronze_products(spark, sf), B.bronze_competitors(spark, sf))
    keep = ["asin", "price", "stock", "source", "parent_asin", "scrape_date"]
    assert rows(read_table(spark, root, SILVER_PRICE_HISTORY).select(keep)) == rows(batch.select(keep))
