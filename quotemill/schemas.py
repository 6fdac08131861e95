"""Table schemas, keys and partition columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _required(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, False)


def _optional(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, True)


# Columns, types and NOT NULL constraints of the stored tables.
PRODUCT_SNAPSHOT = T.StructType(
    [
        _required("asin", T.StringType()),
        _optional("title", T.StringType()),
        _optional("brand", T.StringType()),
        _optional("price", T.DoubleType()),
        _optional("currency", T.StringType()),
        _optional("stock", T.StringType()),
        _optional("rating", T.DoubleType()),
        _optional("url", T.StringType()),
        _optional("images", T.ArrayType(T.StringType())),
        _optional("categories", T.ArrayType(T.StringType())),
        _optional("category_path", T.ArrayType(T.StringType())),
        _optional("buybox", T.StringType()),
        _optional("product_overview", T.StringType()),
        _optional("amazon_domain", T.StringType()),
        _optional("geo_location", T.StringType()),
        _required("scraped_at", T.TimestampType()),
    ]
)
COMPETITOR_SNAPSHOT = T.StructType(
    [
        _required("parent_asin", T.StringType()),
        _required("asin", T.StringType()),
        _optional("title", T.StringType()),
        _optional("brand", T.StringType()),
        _optional("price", T.DoubleType()),
        _optional("currency", T.StringType()),
        _optional("rating", T.DoubleType()),
        _optional("url", T.StringType()),
        _optional("images", T.ArrayType(T.StringType())),
        _optional("amazon_domain", T.StringType()),
        _required("fetched_at", T.TimestampType()),
    ]
)
PRICE_HISTORY = T.StructType(
    [
        _required("asin", T.StringType()),
        _required("price", T.DoubleType()),
        _required("currency", T.StringType()),
        _optional("stock", T.StringType()),
        _optional("rating", T.DoubleType()),
        _required("source", T.StringType()),
        _optional("parent_asin", T.StringType()),
        _required("scrape_date", T.DateType()),
        _required("scraped_at", T.TimestampType()),
        _optional("_updated_at", T.TimestampType()),
    ]
)
COMPETITOR_MAP = T.StructType(
    [
        _required("parent_asin", T.StringType()),
        _required("asin", T.StringType()),
        _optional("title", T.StringType()),
        _optional("brand", T.StringType()),
        _optional("price", T.DoubleType()),
        _optional("currency", T.StringType()),
        _optional("rating", T.DoubleType()),
        _optional("price_diff_pct", T.DoubleType()),
        _optional("price_rank", T.IntegerType()),
        _required("scrape_date", T.DateType()),
        _optional("_updated_at", T.TimestampType()),
    ]
)
PRICE_FEATURES = T.StructType(
    [
        _required("asin", T.StringType()),
        _required("scrape_date", T.DateType()),
        _optional("current_price", T.DoubleType()),
        _optional("currency", T.StringType()),
        _optional("price_7d_ma", T.DoubleType()),
        _optional("price_7d_volatility", T.DoubleType()),
        _optional("price_momentum", T.DoubleType()),
        _optional("comp_median_price", T.DoubleType()),
        _optional("comp_avg_price", T.DoubleType()),
        _optional("comp_min_price", T.DoubleType()),
        _optional("comp_max_price", T.DoubleType()),
        _optional("comp_count", T.IntegerType()),
        _optional("competitors_below", T.IntegerType()),
        _optional("comp_pressure_score", T.DoubleType()),
        _optional("suggested_price", T.DoubleType()),
        _optional("price_position", T.StringType()),
        _optional("_computed_at", T.TimestampType()),
    ]
)
PRICE_PREDICTIONS = T.StructType(
    [
        _required("asin", T.StringType()),
        _required("scrape_date", T.DateType()),
        _optional("predicted_price", T.DoubleType()),
        _optional("current_price", T.DoubleType()),
        _optional("price_diff_pct", T.DoubleType()),
        _optional("model_version", T.StringType()),
        _optional("scored_at", T.TimestampType()),
    ]
)
PRICE_TAILS = T.StructType(
    [
        _required("asin", T.StringType()),
        _required("scrape_date", T.DateType()),
        _optional("price", T.DoubleType()),
        _optional("rating", T.DoubleType()),
        _optional("currency", T.StringType()),
        _optional("stock", T.StringType()),
        _required("as_of", T.DateType()),
    ]
)
LOAD_AUDIT = T.StructType(
    [
        _required("table_name", T.StringType()),
        _optional("batch", T.StringType()),
        _optional("operation", T.StringType()),
        _optional("rows_in", T.LongType()),
        _optional("inserted", T.LongType()),
        _optional("updated", T.LongType()),
        _optional("loaded_at", T.TimestampType()),
    ]
)
RUN_METRICS = T.StructType(
    [
        _required("run", T.StringType()),
        _required("metric", T.StringType()),
        _optional("value", T.DoubleType()),
        _optional("logged_at", T.TimestampType()),
    ]
)
RUN_PARAMETERS = T.StructType(
    [
        _required("run", T.StringType()),
        _required("parameter", T.StringType()),
        _optional("value", T.StringType()),
        _optional("logged_at", T.TimestampType()),
    ]
)
MODEL_VERSIONS = T.StructType(
    [
        _required("version", T.IntegerType()),
        _optional("path", T.StringType()),
        _optional("stage", T.StringType()),
        _optional("rmse", T.DoubleType()),
        _optional("mae", T.DoubleType()),
        _optional("mape", T.DoubleType()),
        _optional("changed_at", T.TimestampType()),
    ]
)


@dataclass(frozen=True)
class Table:
    """One managed table: where it lives, what identifies a row, how it is laid out.

    Files are sorted by ``cluster`` inside a partition, so that row-group statistics let
    a filter on those columns skip most of a file.
    """

    layer: str
    name: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    partition: str | None = None
    stamp: str | None = None
    cluster: tuple[str, ...] = ()
    comment: str = ""

    @property
    def full_name(self) -> str:
        return f"{self.layer}.{self.name}"

    def path(self, root: str) -> str:
        return f"{root.rstrip('/')}/{self.layer}/{self.name}"

    def ddl(self, location: str | None = None) -> str:
        columns = ",\n  ".join(
            f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
            for f in self.schema.fields
        )
        parts = [f"CREATE TABLE IF NOT EXISTS {self.full_name} (\n  {columns}\n) USING parquet"]
        if self.partition:
            parts.append(f"PARTITIONED BY ({self.partition})")
        if location:
            parts.append(f"LOCATION '{location}'")
        parts.append(f"COMMENT '{self.comment}'")
        return "\n".join(parts)


def _ingested(schema: T.StructType) -> T.StructType:
    """A snapshot schema with the columns that ingestion adds."""
    added = [_optional("_ingested_at", T.TimestampType()), _optional("ingest_date", T.DateType())]
    return T.StructType(schema.fields + added)


# ingest_date is the UTC date of the snapshot itself.
BRONZE_PRODUCTS = Table(
    "bronze", "products", _ingested(PRODUCT_SNAPSHOT),
    partition="ingest_date", comment="Raw product snapshots, append-only",
)
BRONZE_COMPETITORS = Table(
    "bronze", "competitors", _ingested(COMPETITOR_SNAPSHOT),
    partition="ingest_date", comment="Raw competitor search results, append-only",
)
SILVER_PRICE_HISTORY = Table(
    "silver", "price_history", PRICE_HISTORY,
    keys=("asin", "scrape_date", "source", "parent_asin"), partition="scrape_date",
    stamp="_updated_at", cluster=("source", "asin"), comment="One cleaned price per key and day",
)
SILVER_COMPETITOR_MAP = Table(
    "silver", "competitor_map", COMPETITOR_MAP,
    keys=("parent_asin", "asin", "scrape_date"), partition="scrape_date",
    stamp="_updated_at", cluster=("parent_asin",), comment="Competitors of each product and day, ranked by price",
)
SILVER_PRICE_TAILS = Table(
    "silver", "price_tails", PRICE_TAILS, keys=("asin", "scrape_date"), partition="as_of",
    cluster=("asin",), comment="Last rows of each own product as of a day",
)
GOLD_PRICE_FEATURES = Table(
    "gold", "price_features", PRICE_FEATURES,
    keys=("asin", "scrape_date"), partition="scrape_date",
    stamp="_computed_at", cluster=("asin",), comment="Feature row per product and day",
)
GOLD_PRICE_PREDICTIONS = Table(
    "gold", "price_predictions", PRICE_PREDICTIONS,
    keys=("asin", "scrape_date"), partition="scrape_date",
    stamp="scored_at", cluster=("asin",), comment="Model output per product and day",
)
OPS_LOAD_AUDIT = Table("ops", "load_audit", LOAD_AUDIT, comment="One row per load")
OPS_RUN_METRICS = Table("ops", "run_metrics", RUN_METRICS, comment="Metrics per run")
OPS_RUN_PARAMETERS = Table("ops", "run_parameters", RUN_PARAMETERS, comment="Parameters per run")
OPS_MODEL_VERSIONS = Table(
    "ops", "model_versions", MODEL_VERSIONS, keys=("version",), comment="Model registry",
)

TABLES = (
    BRONZE_PRODUCTS,
    BRONZE_COMPETITORS,
    SILVER_PRICE_HISTORY,
    SILVER_COMPETITOR_MAP,
    SILVER_PRICE_TAILS,
    GOLD_PRICE_FEATURES,
    GOLD_PRICE_PREDICTIONS,
)


def create_tables(spark, root: str | None = None) -> list[str]:
    """Create the three schemas and their tables; returns the names found afterwards."""
    for layer in sorted({t.layer for t in TABLES}):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}")
    for table in TABLES:
        spark.sql(table.ddl(table.path(root) if root else None))
    return [
        f"{layer}.{t.name}"
        for layer in ("bronze", "silver", "gold")
        for t in spark.catalog.listTables(layer)
    ]
