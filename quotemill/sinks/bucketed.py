"""Keyed upsert into a bucketed catalog table, without moving the stored side.

Rows are stored in ``buckets`` files per partition value by a hash of ``_key``, a digest of
the key columns that is never null, and sorted by it. A merge joins on ``_key`` alone: the
stored buckets already are that join's partitions, so only the new rows are shuffled, and
what comes out is written bucket by bucket without another exchange. The work of a merge on
stored rows is a sequential read and write of the touched partitions.

One writer per table at a time; a merge is atomic per partition value, like ``upsert_table``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import duplicate_keys, merge_rows
from ..schemas import Table
from ..session import scratch_path
from .tables import conform

KEY = "_key"


def key_digest(columns: Sequence[str]) -> Column:
    """MD5 over the columns' texts with their lengths; null differs from every text."""
    parts = []
    for name in columns:
        text = F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.md5(F.concat(*parts).cast("binary"))


def create_bucketed(spark: SparkSession, table: Table, name: str, buckets: int, path: str | None = None) -> None:
    """Create the empty catalog table ``name`` for rows of ``table``."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema.fields)
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {KEY} STRING) USING parquet "
        f"PARTITIONED BY ({table.partition}) CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS{place}"
    )


def bucket_count(spark: SparkSession, name: str) -> int:
    facts = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Num Buckets'").first()
    return int(facts["data_type"])


def merged_buckets(source: DataFrame, table: Table, name: str, values: Sequence, newer: str | None = None) -> DataFrame:
    """The touched partitions of ``name`` after the merge, in the layout of the table.

    ``source`` has the table's columns and ``_key``, unique per row.
    """
    spark = source.sparkSession
    buckets = bucket_count(spark, name)
    target = spark.table(name).where(F.col(table.partition).isin(list(values)))
    order = target.columns
    # As many partitions as buckets, by the hash that bucketing uses.
    incoming = source.select(*order).repartition(buckets, KEY)
    return merge_rows(target, incoming, [KEY], newer=newer, null_safe=False).select(*order)


def upsert_bucketed(source: DataFrame, table: Table, name: str, newer: str | None = None) -> int:
    """Merge ``source`` into the bucketed table ``name``; returns the rows of the source.

    Repeated keys in the source raise before anything is written.
    """
    spark = source.sparkSession
    path = scratch_path(spark, "bucketed-load")
    rows = conform(source, table)
    if table.stamp:
        rows = rows.withColumn(table.stamp, F.current_timestamp())
    rows.withColumn(KEY, key_digest(table.keys)).write.parquet(path)
    staged = spark.read.parquet(path)
    if not duplicate_keys(staged, [KEY]).isEmpty():
        raise ValueError(f"source rows for {name} repeat a key {table.keys}")
    per_day = staged.groupBy(table.partition).count().collect()
    if not per_day:
        return 0
    merged = merged_buckets(staged, table, name, [r[0] for r in per_day], newer)
    # The setting of the session is put back: only this write replaces single partitions.
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        merged.write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(setting, before)
    spark.catalog.refreshTable(name)
    return reduce(lambda n, r: n + r["count"], per_day, 0)
