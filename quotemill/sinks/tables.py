"""Append and keyed upsert into partitioned Parquet tables, with a load audit.

A table has one writer at a time: partition overwrite is atomic per partition directory,
not across them, and there is no concurrency control.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import duplicate_keys, merge_rows
from ..schemas import OPS_LOAD_AUDIT, OPS_RUN_METRICS, OPS_RUN_PARAMETERS, Table
from ..session import literal_rows


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def _read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return literal_rows(spark, [], schema)


def read_table(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """The stored rows; a table that was never written is empty."""
    return _read_or_empty(spark, table.path(root), _nullable(table.schema))


def _register(spark: SparkSession, table: Table, root: str, values: Sequence) -> None:
    """Make the partitions with these values known to the catalog, where it holds the table at this place."""
    if not (table.partition and values and spark.catalog.tableExists(table.full_name)):
        return
    facts = spark.sql(f"DESCRIBE TABLE EXTENDED {table.full_name}").where("col_name = 'Location'").first()
    place = facts["data_type"].removeprefix("file:").rstrip("/") if facts else ""
    if place.lstrip("/") == table.path(root).removeprefix("file:").rstrip("/").lstrip("/"):
        parts = " ".join(f"PARTITION ({table.partition} = '{v}')" for v in values if v is not None)
        if parts:
            spark.sql(f"ALTER TABLE {table.full_name} ADD IF NOT EXISTS {parts}")
        spark.catalog.refreshTable(table.full_name)


def conform(df: DataFrame, table: Table) -> DataFrame:
    """Columns in table order and type; columns the frame lacks are null."""
    columns = []
    for field in table.schema.fields:
        source = F.col(field.name) if field.name in df.columns else F.lit(None)
        columns.append(source.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def _audit(
    spark: SparkSession, root: str, table: Table, batch: str, operation: str,
    rows_in: int, inserted: int, updated: int, at: datetime | None = None,
) -> dict:
    row = {
        "table_name": table.full_name,
        "batch": batch,
        "operation": operation,
        "rows_in": rows_in,
        "inserted": inserted,
        "updated": updated,
        "loaded_at": at or datetime.now(timezone.utc),
    }
    frame = literal_rows(spark, [tuple(row.values())], OPS_LOAD_AUDIT.schema)
    frame.coalesce(1).write.mode("append").parquet(OPS_LOAD_AUDIT.path(root))
    return row


def _laid_out(df: DataFrame, table: Table) -> DataFrame:
    """Few files per partition value, sorted by the table's cluster columns.

    Rows are rebalanced by the partition column; adaptive execution splits a value that is
    much larger than the others and merges small ones.
    """
    rows = df.hint("rebalance", F.col(table.partition))
    return rows.sortWithinPartitions(table.partition, *table.cluster) if table.cluster else rows


def _overwrite_partitions(df: DataFrame, table: Table, root: str, values: Sequence) -> None:
    """Replace the partitions present in ``df``; the others stay."""
    (
        _laid_out(df, table)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(table.partition)
        .parquet(table.path(root))
    )
    _register(df.sparkSession, table, root, values)


@dataclass(frozen=True)
class Admitted:
    """Rows of a load that satisfy the table's constraints, stored in the staging folder."""

    rows: DataFrame
    count: int
    rejected: int
    days: tuple


def _admit(df: DataFrame, table: Table, root: str, batch: str, quarantine: bool) -> Admitted:
    """Store the rows of a load once and check NOT NULL columns in the same pass.

    The staging folder holds the last load of the table. Rows without a value in a NOT NULL
    column are refused with the whole load (ValueError), or, with ``quarantine``, appended
    to the table's reject folder with the columns that they lack.
    """
    spark = df.sparkSession
    required = [f.name for f in table.schema.fields if not f.nullable]
    seen = Observation()
    counts = [F.count_if(F.col(c).isNull()).alias(f"no_{c}") for c in required]
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required], F.lit(True))
    path = f"{root.rstrip('/')}/_staging/{table.full_name}"
    observed = conform(df, table).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(whole).alias("whole"), *counts
    )
    observed.write.mode("overwrite").parquet(path)
    staged = spark.read.schema(_nullable(table.schema)).parquet(path)
    facts = seen.get
    rejected = facts["rows"] - facts["whole"]
    if rejected:
        missing = [c for c in required if facts[f"no_{c}"]]
        if not quarantine:
            raise ValueError(f"source rows for {table.full_name} lack a value in one of {missing}")
        lacks = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in missing]))
        refused = staged.where(~whole).withColumns(
            {"_lacks": lacks, "_batch": F.lit(batch), "_rejected_at": F.current_timestamp()}
        )
        refused.write.mode("append").parquet(_reject_path(table, root))
        staged = staged.where(whole)
    days = tuple(r[0] for r in staged.select(table.partition).distinct().collect()) if table.partition else ()
    return Admitted(staged, facts["whole"], rejected, days)


def _reject_path(table: Table, root: str) -> str:
    return f"{root.rstrip('/')}/_rejected/{table.full_name}"


def rejected_rows(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """Rows that loads refused: the table's columns, ``_lacks``, ``_batch``, ``_rejected_at``."""
    extra = "_lacks array<string>, _batch string, _rejected_at timestamp"
    schema = T.StructType(_nullable(table.schema).fields + T.StructType.fromDDL(extra).fields)
    return _read_or_empty(spark, _reject_path(table, root), schema)


@dataclass(frozen=True)
class MicroBatch:
    """Identity of a batch that may be delivered more than once."""

    query: str
    number: int

    @property
    def label(self) -> str:
        return f"{self.query}/{self.number}"


def _once(
    spark: SparkSession, root: str, table: Table, batch: MicroBatch | None, write: Callable[[bool], dict]
) -> dict:
    """Run ``write`` unless the load audit shows the batch as done.

    A row with operation BEGIN stands in the audit from before the write. A batch that has
    it and no result was cut off: ``write(True)`` has to bear rows that are already stored.
    """
    if batch is None:
        return write(False)
    known = read_table(spark, root, OPS_LOAD_AUDIT).where(
        (F.col("table_name") == table.full_name) & (F.col("batch") == batch.label)
    ).collect()
    done = next((r.asDict() for r in known if r["operation"] != "BEGIN"), None)
    if done:
        return {**done, "replayed": True}
    if not known:
        _audit(spark, root, table, batch.label, "BEGIN", 0, 0, 0)
    return write(bool(known))


def append_table(
    df: DataFrame, table: Table, root: str, batch: str | MicroBatch = "", quarantine: bool = False
) -> dict:
    """Append rows that satisfy the table's constraints. No rows, no write.

    A ``MicroBatch`` that is already in the audit is not appended again; of one that was cut
    off only rows that are not stored yet are (repeated rows inside it count as one).
    """
    spark = df.sparkSession
    once = batch if isinstance(batch, MicroBatch) else None
    label = once.label if once else batch

    def write(resumed: bool) -> dict:
        load = _admit(df, table, root, label, quarantine)
        rows, n = load.rows, load.count
        if resumed and n:
            stored = read_table(spark, root, table)
            if table.partition:
                stored = stored.where(F.col(table.partition).isin(list(load.days)))
            same = list(table.keys) or [c for c in table.schema.fieldNames() if not c.startswith("_")]
            path = f"{root.rstrip('/')}/_staging/{table.full_name}-resumed"
            new_rows_only(rows, stored, same).dropDuplicates(same).write.mode("overwrite").parquet(path)
            rows = spark.read.schema(rows.schema).parquet(path)
            n = rows.count()
        if n and table.partition:
            _laid_out(rows, table).write.mode("append").partitionBy(table.partition).parquet(table.path(root))
            _register(spark, table, root, load.days)
        elif n:
            rows.write.mode("append").parquet(table.path(root))
        return _audit(spark, root, table, label, "APPEND", load.count + load.rejected, n, 0)

    return _once(spark, root, table, once, write)


def new_rows_only(df: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are not stored yet, so that a repeated append adds nothing."""
    same = [F.col(f"_new.{k}").eqNullSafe(F.col(f"_old.{k}")) for k in keys]
    known = stored.select(*keys).alias("_old")
    return df.alias("_new").join(known, reduce(lambda a, b: a & b, same), "left_anti")


def upsert_table(
    source: DataFrame,
    table: Table,
    root: str,
    batch: str | MicroBatch = "",
    update_columns: Sequence[str] | None = None,
    newer: str | None = None,
    quarantine: bool = False,
) -> dict:
    """Update matching keys, insert the rest, and rewrite only the touched partitions.

    The rows are staged first: they are read for the key check, the partition list and the
    merge. Duplicate source keys raise before anything is written; so do rows without a
    value in a NOT NULL column, unless they go to ``quarantine``. With ``newer`` a stored
    row gives way only to one whose ``newer`` column is not below its own. A ``MicroBatch``
    that the audit shows as done is skipped.
    """
    spark = source.sparkSession
    once = batch if isinstance(batch, MicroBatch) else None
    label = once.label if once else batch

    def write(resumed: bool) -> dict:
        staged, columns = source, update_columns
        if table.stamp:
            staged = staged.withColumn(table.stamp, F.current_timestamp())
            columns = [*columns, table.stamp] if columns is not None else None
        load = _admit(staged, table, root, label, quarantine)
        rows_in = load.count + load.rejected
        if not load.count:
            return _audit(spark, root, table, label, "MERGE", rows_in, 0, 0)
        if not duplicate_keys(load.rows, table.keys).isEmpty():
            raise ValueError(f"source rows for {table.full_name} repeat a key {table.keys}")
        target = read_table(spark, root, table).where(F.col(table.partition).isin(list(load.days)))
        seen = Observation()
        merged = merge_rows(target, load.rows, table.keys, columns, flags=True, newer=newer)
        counted = merged.observe(
            seen, F.count_if("_inserted").alias("inserted"), F.count_if("_matched").alias("updated")
        )
        _overwrite_partitions(counted.drop("_inserted", "_matched"), table, root, load.days)
        counts = seen.get
        return _audit(spark, root, table, label, "MERGE", rows_in, counts["inserted"], counts["updated"])

    return _once(spark, root, table, once, write)


def replace_partition(df: DataFrame, table: Table, root: str, batch: str, quarantine: bool = False) -> dict:
    """Write ``df`` as the new content of its partitions."""
    spark = df.sparkSession
    started = datetime.now(timezone.utc)
    load = _admit(df, table, root, batch, quarantine)
    if load.count:
        _overwrite_partitions(load.rows, table, root, load.days)
    return _audit(spark, root, table, batch, "REPLACE", load.count + load.rejected, load.count, 0, started)


def create_views(spark: SparkSession, root: str, tables: Sequence[Table]) -> None:
    """Temporary views named ``layer_table`` for SQL text."""
    for table in tables:
        read_table(spark, root, table).createOrReplaceTempView(f"{table.layer}_{table.name}")


def log_metrics(spark: SparkSession, root: str, run: str, metrics: dict[str, float]) -> None:
    """Append one row per metric of a run."""
    now = datetime.now(timezone.utc)
    rows = [(run, name, None if v is None else float(v), now) for name, v in metrics.items()]
    frame = literal_rows(spark, rows, OPS_RUN_METRICS.schema)
    frame.coalesce(1).write.mode("append").parquet(OPS_RUN_METRICS.path(root))


def log_parameters(spark: SparkSession, root: str, run: str, parameters: dict[str, object]) -> None:
    """Append one row per parameter of a run, as text; null stays null."""
    now = datetime.now(timezone.utc)
    rows = [(run, name, None if v is None else str(v), now) for name, v in parameters.items()]
    frame = literal_rows(spark, rows, OPS_RUN_PARAMETERS.schema)
    frame.coalesce(1).write.mode("append").parquet(OPS_RUN_PARAMETERS.path(root))
