"""Streaming ingestion: snapshot folders into bronze, bronze snapshots into silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.silver import silver_price_history
from ..schemas import (
    BRONZE_COMPETITORS,
    BRONZE_PRODUCTS,
    COMPETITOR_SNAPSHOT,
    PRODUCT_SNAPSHOT,
    SILVER_PRICE_HISTORY,
    Table,
)
from ..session import stored
from ..sinks.tables import MicroBatch, conform, upsert_table


def stream_snapshots(
    spark: SparkSession, folder: str, schema: T.StructType, multi_line: bool = True,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New JSON files below ``folder`` as a stream."""
    reader = spark.readStream.schema(schema).option("multiLine", multi_line)
    reader = reader.option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def append_stream(
    snapshots: DataFrame, table: Table, root: str, checkpoint: str, time: str
) -> StreamingQuery:
    """Append keyed snapshots to a bronze table and stop when the folder is drained."""
    stamped = snapshots.where(F.col("asin").isNotNull()).withColumns(
        {"_ingested_at": F.current_timestamp(), "ingest_date": F.to_date(time)}
    )
    return (
        conform(stamped, table)
        .writeStream.format("parquet")
        .partitionBy("ingest_date")
        .option("checkpointLocation", checkpoint)
        .option("path", table.path(root))
        .trigger(availableNow=True)
        .start()
    )


def stream_bronze_products(spark: SparkSession, snapshots: str, root: str, checkpoint: str, **options):
    rows = stream_snapshots(spark, f"{snapshots}/products", PRODUCT_SNAPSHOT, **options)
    return append_stream(rows, BRONZE_PRODUCTS, root, checkpoint, "scraped_at")


def stream_bronze_competitors(spark: SparkSession, snapshots: str, root: str, checkpoint: str, **options):
    rows = stream_snapshots(spark, f"{snapshots}/competitors", COMPETITOR_SNAPSHOT, **options)
    return append_stream(
        rows.where(F.col("parent_asin").isNotNull()), BRONZE_COMPETITORS, root, checkpoint, "fetched_at"
    )


def upsert_silver_stream(
    products: DataFrame, competitors: DataFrame, root: str, checkpoint: str,
    deliveries: int = 1,
) -> StreamingQuery:
    """Clean each micro-batch and upsert it into the price history.

    A late snapshot never replaces a newer stored one. The load audit is the ledger: a batch
    that it shows as done under this query's id (kept in the checkpoint) is skipped when a
    restart delivers it again. ``deliveries`` above one rehearses that.
    """
    names = sorted(set(products.columns) | set(competitors.columns))

    def widen(df: DataFrame, kind: str) -> DataFrame:
        types = {f.name: f.dataType for f in [*products.schema.fields, *competitors.schema.fields]}
        columns = [
            F.col(n) if n in df.columns else F.lit(None).cast(types[n]).alias(n) for n in names
        ]
        return df.select(F.lit(kind).alias("_kind"), *columns)

    both = widen(products, "product").unionByName(widen(competitors, "competitor"))

    def write(batch: DataFrame, batch_id: int) -> None:
        name = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        rows = stored(batch, "micro_batch")
        own = rows.where("_kind = 'product'").select(*products.columns)
        rivals = rows.where("_kind = 'competitor'").select(*competitors.columns)
        for _ in range(deliveries):
            upsert_table(
                silver_price_history(own, rivals), SILVER_PRICE_HISTORY, root,
                MicroBatch(name, batch_id), newer="scraped_at",
            )

    return (
        both.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
