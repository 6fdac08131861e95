"""Snapshot, CSV and manifest readers."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.binning import as_day
from ..functions.text import normalise_key, strip
from ..schemas import COMPETITOR_SNAPSHOT, PRODUCT_SNAPSHOT
from ..session import literal_rows, stored

CORRUPT = "_corrupt_record"


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def read_json_folder(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True
) -> DataFrame:
    """Rows of one folder with an explicit schema; a missing folder is empty.

    ``multi_line`` reads files that each hold one object or one array of objects; without
    it files hold one object per line and large files are split between tasks. A record
    that is not JSON comes back with its text in ``_corrupt_record``.
    """
    full = T.StructType(_nullable(schema).fields + [T.StructField(CORRUPT, T.StringType())])
    reader = (
        spark.read.schema(full)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("recursiveFileLookup", True)
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    try:
        return reader.json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return literal_rows(spark, [], full)


def split_corrupt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable rows, quarantined text). A row with one bad field stays readable.

    The parsed rows are stored first: the corrupt-record column is only reliable when all
    columns are parsed together.
    """
    parsed = stored(rows, "parsed")
    bad = F.col(CORRUPT).isNotNull() & F.try_parse_json(CORRUPT).isNull()
    return parsed.where(~bad).drop(CORRUPT), parsed.where(bad).select(CORRUPT)


def _snapshot(
    spark: SparkSession, root: str, kind: str, day: str | date, schema: T.StructType,
    required: tuple[str, ...], time: str, multi_line: bool,
) -> DataFrame:
    run_day = as_day(day)
    path = f"{root.rstrip('/')}/{kind}/{run_day.isoformat()}"
    rows = read_json_folder(spark, path, schema, multi_line).drop(CORRUPT)
    for name in required:
        rows = rows.where(F.col(name).isNotNull())
    # The partition follows the snapshot's own date: a run that passes midnight writes two.
    snapshot_day = F.coalesce(F.to_date(time), F.lit(run_day))
    return rows.withColumns({"_ingested_at": F.current_timestamp(), "ingest_date": snapshot_day})


def read_products(
    spark: SparkSession, root: str, day: str | date = "", multi_line: bool = True
) -> DataFrame:
    """Product snapshots of one day, keyed rows only, with the ingestion stamp."""
    return _snapshot(spark, root, "products", day, PRODUCT_SNAPSHOT, ("asin",), "scraped_at", multi_line)


def read_competitors(
    spark: SparkSession, root: str, day: str | date = "", multi_line: bool = True
) -> DataFrame:
    """Competitor snapshots of one day; every file holds an array, one row per element."""
    required = ("asin", "parent_asin")
    return _snapshot(spark, root, "competitors", day, COMPETITOR_SNAPSHOT, required, "fetched_at", multi_line)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Tracked keys: one per line, trimmed and upper-cased; blanks and ``#`` lines skipped."""
    lines = spark.read.text(path)
    kept = lines.where((strip(F.col("value")) != "") & ~F.col("value").startswith("#"))
    return kept.select(normalise_key(F.col("value")).alias("asin"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and an explicit schema; dates as yyyy-MM-dd."""
    return spark.read.schema(schema).option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
